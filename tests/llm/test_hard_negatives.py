"""Op 12 against brute force, with odd rows, ties, copies and very large components."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import hard_negatives as hn
from ledgerline.llm.common import prepare

SCHEMA = "vec_id long, embedding array<double>, label int"
LONG = (1 << 63) - 1


def brute(rows):
    own = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = int(math.fmod(label + 1, 10)) if i is not None and i % 7 == 0 else label
        own.append((i, [math.floor(x * 256) if abs(x) < 1 << 53 else int(x) * 256 for x in v], label))
    out = []
    score = lambda a, b: max(-LONG - 1, min(LONG, sum(x * y for x, y in zip(a, b))))
    key = lambda r: (-r[1], r[0] is None, r[0] or 0)
    for n, (i, v, label) in enumerate(own):
        if i is None or i % 100:
            continue
        scored = [(j, score(v, w), other) for m, (j, w, other) in enumerate(own) if m != n]
        for p, s, _ in sorted([r for r in scored if r[2] == label], key=key)[:5]:
            found = sorted([r for r in scored if r[2] != label and 30 * s <= 100 * r[1] <= 90 * s], key=key)[:10]
            out += [(i, p, k, j, s, t) for k, (j, t, _) in enumerate(found, 1)]
    return sorted(out, key=str)


def answer(df):
    return sorted((tuple(r) for r in hn.op12(df).collect()), key=str)


def rows_of(rng, n, spread=1.0):
    rows = []
    for i in range(n):
        v = [rng.uniform(-spread, spread) if rng.random() < .8 else rng.choice([0.0, -0.0, 0.5]) for _ in range(12)]
        rows.append((i, v, rng.randrange(10)))
    return rows


def test_odd_rows(spark, monkeypatch):
    prepare(spark)
    rng = random.Random(1)
    rows = rows_of(rng, 900)
    rows += [(5000, None, 1), (5100, [1.0] * 12, None), (5200, [float("nan")] * 12, 2), (5300, [float("inf")] * 12, 2), (5400, [None] * 12, 3),
             (5500, [0.3] * 20, 4), (5600, [], 5), (5700, [0.4], 6), (None, [0.5] * 12, 7), (None, [0.5] * 12, 7), (-700, [0.2] * 12, -12),
             (300, rows[300][1], rows[300][2]), (300, rows[300][1], rows[300][2]), (400, [0.1] * 12, rows[400][2])]
    rows += [(6000 + k, rows[7][1], rows[7][2] if k % 2 else (rows[7][2] + 1) % 10) for k in range(60)]  # one common vector: ties
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumn("score", F.lit("x")).withColumn("anchor", F.lit(1)).withColumn("rank", F.lit(2))
    want = brute(rows)
    assert len(want) > 200 and answer(df) == want
    monkeypatch.setattr(hn, "ANCHORS", 3)
    monkeypatch.setattr(hn, "ROWS", 50)
    assert answer(df) == want
    assert answer(df.limit(0)) == [] and answer(df.where("vec_id % 100 <> 0")) == []


@pytest.mark.parametrize("spread", [1e4, 1e12, 1e40])
def test_large_components(spark, spread):
    """Fields of over 64 bits: integers of any width; scores that no long holds stay at its end."""
    prepare(spark)
    rows = rows_of(random.Random(2), 260, spread)
    rows += [(1000, [spread] * 12, 3), (1001, [spread / 2] * 12, 3), (1002, [spread / 3] * 12, 4)]
    assert answer(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_packed_products_are_exact():
    rng = np.random.default_rng(4)
    for low, high, width in ((-300, 300, 64), (-5, 9, 3), (0, 1, 200), (-(1 << 20), 1 << 20, 16), (-(1 << 31), 1 << 31, 4), (7, 8, 1)):
        rows, anchors = rng.integers(low, high, (37, width)), rng.integers(low, high, (5, width))
        packed = hn.Packed(rows, int(anchors.min()), int(anchors.max()))
        want = [[max(-LONG - 1, min(LONG, sum(int(x) * int(y) for x, y in zip(a, r)))) for r in rows] for a in anchors]
        assert packed.scores(anchors).tolist() == want, (low, high)
    assert hn.Packed(rng.integers(-140, 140, (9, 64)), -140, 140).per >= 2     # several candidates in one integer
