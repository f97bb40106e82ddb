"""Named queries over the given tables, each with equivalent SQL where SQL can say it."""

from recordmill.catalog.base import ORACLES, QUERIES
from recordmill.catalog import (  # noqa: F401  (registration by import)
    audits,
    batches,
    entities,
    history,
    pages,
    records,
    streams,
    texts,
)

__all__ = ["ORACLES", "QUERIES"]
