"""A pair that shares one anchor only, in a key that many unlike texts share as well."""

import numpy as np
from pyspark.sql import functions as F

from recordmill.llm import simhash

SIZE = 5
WORDS = [f"w{i}" for i in range(4000)]


def anchors_of(text):
    return simhash.fingerprint(text.encode(), SIZE, 4, simhash.ANCHORS, once=True)


def pair_of_one_anchor(rng):
    """Two texts at similarity 0.8 or more that share one anchor, and that anchor's place."""
    while True:
        words = rng.choice(WORDS, 60).tolist()
        a, b = " ".join(words), " ".join(words[:-6] + rng.choice(WORDS, 6).tolist())
        (fp, x), (gp, y) = anchors_of(a), anchors_of(b)
        sets = [simhash.shingle_set(t.encode(), SIZE) for t in (a, b)]
        shared = len(np.intersect1d(*sets))
        far = int(np.unpackbits((fp ^ gp).view(np.uint8)).sum())
        if (x == y).sum() == 1 and far <= 60 and shared >= 0.8 * (len(sets[0]) + len(sets[1]) - shared):
            return a, b, int(np.flatnonzero(x == y)[0])


def test_a_crowded_anchor_loses_no_pair(spark):
    rng = np.random.default_rng(4)
    a, b, at = pair_of_one_anchor(rng)
    words, key = a.split(), anchors_of(a)[1][at]
    windows = [" ".join(words[i:i + SIZE]) for i in range(len(words) - SIZE + 1)]
    first, second = (min(windows, key=lambda w: simhash._mixed(simhash.shingle_set(w.encode(), SIZE), 100 + 2 * at + j)[0]) for j in (0, 1))
    unlike = set()
    while len(unlike) < 700:
        text = " ".join([first, *rng.choice(WORDS, 3), second, *rng.choice(WORDS, 3)])
        if anchors_of(text)[1][at] == key:
            unlike.add(text)
    # The pair lies in different tiles of the key, whatever tile a number falls into.
    tile = [r[0] for r in spark.range(702).select(F.pmod(F.xxhash64("id"), F.lit(2))).collect()]
    texts = sorted(unlike)
    for place, text in sorted([(tile.index(0), a), (tile.index(1), b)]):
        texts.insert(place, text)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    kept = {r["doc_id"] for r in simhash.first_of_group(docs).collect()}
    assert kept == set(range(702)) - {max(tile.index(0), tile.index(1))}
