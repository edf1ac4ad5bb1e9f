"""Bloom filters of base files: memory bounded per task, work that follows the rows."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerline.operators import upsert as U


def _peak_mb(call) -> float:
    tracemalloc.start()
    try:
        call()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_probing_and_building_hold_little_memory():
    hashes = np.random.default_rng(1).integers(0, 2**64, 500_000, dtype=np.uint64)
    bloom = U.bloom_filter(hashes[:100_000])
    assert U.may_hold(bloom, hashes[99_999:]) and U.may_hold(bloom, hashes[:1])
    empty = bytes(8)                                                      # holds nothing: every key is tried
    assert not U.may_hold(empty, hashes)
    assert _peak_mb(lambda: U.may_hold(empty, hashes)) < 2                # before: 7 places a key at once
    assert _peak_mb(lambda: U.bloom_filter(hashes)) < 50                  # 10 bits and one place a key


def test_a_large_file_has_several_filters(monkeypatch):
    monkeypatch.setattr(U, "BLOOM_KEYS", 1000)
    hashes = np.random.default_rng(2).integers(-2**63, 2**63, 7000)
    files = ["a"] * 3300 + ["b"] + ["c"] * 3699
    batches = [pa.RecordBatch.from_pydict({"file": files[i:i + 500], "h": hashes[i:i + 500]}) for i in range(0, 7000, 500)]
    found = [r for b in U._filters(iter(batches)) for r in b.to_pylist()]
    counts = {n: [r["keys"] for r in found if r["file"] == n] for n in "abc"}
    assert {n: sum(c) for n, c in counts.items()} == {"a": 3300, "b": 1, "c": 3699}
    assert max(map(max, counts.values())) <= 1500 and len(counts["a"]) >= 3
    for name, key in zip(files[::50], hashes[::50].view(np.uint64)):
        assert any(U.may_hold(r["bits"], key[None]) for r in found if r["file"] == name)


def test_keys_are_sent_until_every_file_is_decided(spark, tmp_base, monkeypatch):
    """A batch that touches every file is decided by its first keys, not sent whole; a key in no early block is still found."""
    monkeypatch.setattr(U, "KEYS_AT_ONCE", 100)
    monkeypatch.setattr(U, "BLOOM_KEYS", 300)
    rows = spark.range(4000).select(F.col("id").cast("string").alias("k"), F.pmod("id", F.lit(4)).cast("string").alias("p"))
    U.upsert(spark, tmp_base, rows, key="k", partition_cols=("p",), cluster_by_partition=True)
    snap = U.snapshot(spark, tmp_base)
    sent, send = [], spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda v: sent.append(1) or send(v))
    assert len(U.files_with(spark, tmp_base, snap, rows.select("k"))) == 4
    assert len(sent) <= 3                                                 # before: 40 blocks
    monkeypatch.setattr(U, "KEYS_AT_ONCE", 1)
    for p in range(4):  # foreign keys are told apart, own ones are found whatever their block
        own = spark.createDataFrame([(f"{4 * i + p}",) for i in range(3)], "k string")
        assert any(f"/p={p}/" in f for f in U.files_with(spark, tmp_base, snap, own))
    assert len(U.files_with(spark, tmp_base, snap, spark.createDataFrame([("none",)], "k string"))) <= 2
