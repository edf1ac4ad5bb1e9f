import hashlib
import random

import numpy as np

from ledgerline.llm import suffix_dedup as sd
from ledgerline.llm.common import prepare
from ledgerline.llm.suffix_sort import Suffixes


def brute(rows):
    """(id, n_bytes, n_removed, n_spans, sha) with ids distinct."""
    first, out = {}, []
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - 99):
            w = b[p:p + 100]
            if w in first:
                gone[p:p + 100] = [True] * 100
            else:
                first[w] = i
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    rng = random.Random(11)
    say = lambda n: " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(n))
    passage, rows = say(60), []
    for i in range(60):
        rows.append((i, say(rng.randint(0, 80))))
    for i in range(60, 110):
        rows.append((i, say(20) + passage + say(10)))
    for i in range(110, 150):
        words = rows[rng.randint(0, 109)][1].split(" ")
        words[rng.randrange(len(words))] = say(1)
        rows.append((i, " ".join(words)))
    rows += [(150, None), (151, ""), (152, "x" * 99), (153, "x" * 100), (154, "x" * 5000), (155, "ab" * 400), (156, "ba" * 300),
             (157, (say(30) + "\n") * 6), (158, say(6000)), (159, "x" * 101)]
    rng.shuffle(rows)
    return rows


def test_equals_brute_force_over_chunk_sizes_and_crowded_anchors(spark):
    prepare(spark)
    rows = corpus()
    df = spark.createDataFrame([(i, t, 0, "clash") for i, t in rows], "doc_id long, text string, n_removed int, chunk string").repartition(3)
    want = brute(rows)
    for options in ({}, {"chunk_bytes": 4000, "bucket_bytes": 30000}, {"chunk_bytes": 3000, "hot": 4}):
        got = sorted(tuple(r) for r in sd.dedup(df, **options).collect())
        assert got == want, options


def test_spans_and_kept_bytes_and_odd_tables(spark):
    prepare(spark)
    assert sd.op4(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh") for _ in range(300))
    df = spark.createDataFrame([(None, text), (3, text), (3, text), (5, "head " + text[:150] + " tail")], "doc_id long, text string")
    rows = {(r.doc_id, r.n_removed): r for r in sd.dedup(df.coalesce(1), full=True).collect()}
    assert sorted((str(k[0]), k[1]) for k in rows) == [("3", 300), ("5", 150), ("None", 0)]
    assert rows[(5, 150)].kept == b"head  tail" and [tuple(s) for s in rows[(5, 150)].spans] == [(5, 155)]


def test_suffix_sort_is_verified_against_the_bytes():
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 99, 4000).astype(np.uint8)
    raw[1000:2000] = raw[0:1000]
    starts, group = np.arange(0, 3800), np.repeat([0, 1], [2500, 1300])
    for value in (None, np.ones(256, np.uint64)):  # the second hash cannot tell any bytes apart
        s = Suffixes(raw, 60) if value is None else Suffixes(raw, 60, value)
        order, cls = s.classes(starts, group)
        text = [raw[i:i + 60].tobytes() for i in starts[order]]
        for g in (0, 1):
            own = [t for t, k in zip(text, group) if k == g]
            assert own == sorted(own)
        pairs = {(group[k], text[k], c) for k, c in enumerate(cls)}
        assert len(pairs) == len({(a, b) for a, b, _ in pairs}) == len(set(cls))
