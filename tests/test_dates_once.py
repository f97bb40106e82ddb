"""A date's text may be dear to get, as when it is taken out of a record: the functions on dates take it once."""

import pytest
from pyspark.sql import functions as F

from recordmill.functions import times as T


@pytest.mark.parametrize("read", [T.relative_strict, T.relative_loose, T.parse_timestamp, T.freshness])
def test_text_of_a_date_is_taken_once(spark, read):
    rows = spark.createDataFrame([("2024-01-30t12:00:00z",)], "d string")
    ref = F.lit("2024-01-31T00:00:00Z").cast("timestamp")
    plan = rows.select(read(F.translate("d", "tz", "TZ"), ref).alias("found"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("translate(") == 1
