"""Cases that an operator once did by less than the whole: short lines, copies, rare classes, repeated items."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as cp
from ledgerline.llm import decontaminate, language_id, quality_classifier, substring_dedup, suffix_dedup
from ledgerline.llm.common import prepare

rng = random.Random(5)
say = lambda n, a="abcdefgh": " ".join("".join(rng.choice(a) for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_pipeline_drops_passages_of_short_and_unspaced_lines(spark):
    prepare(spark)
    verse = "\n".join(say(3) for _ in range(20))
    han = "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(60))
    headed = "Title\n" + say(12) + "\n\n" + "\n".join(say(2) for _ in range(3))
    own = [say(12) for _ in range(6)]
    rows = [(1, own[0] + "\n" + verse + "\n" + own[1]), (2, own[2] + "\n" + verse + "\n" + own[3]), (3, own[4] + "\n" + han),
            (4, han + "\n" + own[5]), (5, headed), (6, headed), (7, "Yes.\nNo."), (8, "yes.\n\nno. "), (9, "Yes.\n" + say(11))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in cp.line_dedup(spark, df, "").collect()}
    assert {i: got[i] for i in (1, 3, 5, 7, 9)} == {i: t for i, t in rows if i in (1, 3, 5, 7, 9)}  # first places; chance repeats
    assert got[2] == own[2] + "\n" + own[3] and got[4] == own[5] and got[6] == got[8] == ""


def test_a_repeated_passage_goes_but_for_its_ends():
    """A passage of over 50 words inside other lines loses all its units that begin and end in it."""
    import pyarrow as pa
    for _ in range(100):
        part = " ".join(say(rng.randint(2, 9), "abcdef").capitalize() + rng.choice([".", "!", "\n"]) for _ in range(14))
        one, two = (f"{say(rng.randint(1, 9), 'xyz')} {part} {say(9, 'xyz')}" for _ in range(2))
        units = substring_dedup.Units(pa.array([one, two]))
        d1, d2 = (x.tolist() for x in units.digests())
        own = list(zip(d1, d2))
        first, second = own[:units.at[1]], own[units.at[1]:]
        gone = [n for n, d in enumerate(second) if d in set(first)]
        words = units.words[units.at[1]:]
        assert len(second) - len(set(gone)) <= 3 and gone == list(range(gone[0], gone[-1] + 1))
        assert substring_dedup.passages(gone, words, words * 0, False) == gone


def test_languages_of_many_copies_and_short_texts_are_learned(spark):
    prepare(spark)
    copies, own, tiny = [say(30, "klmno") for _ in range(3)], [say(30, "abcde") for _ in range(200)], [say(2, "vwxyz") for _ in range(400)]
    rows = [(t, "copied") for t in copies for _ in range(1500)] + [(t, "own") for t in own] + [(t, "tiny") for t in tiny]
    rows += [("pq " * 9000 + str(n), "long") for n in range(3)] + [("pq", "long")] + [(copies[0], None), ("12 !", "none")]
    df = spark.createDataFrame(rows, "text string, lang string")
    got = language_id.samples(df)
    held = {l: sorted(x.tobytes() for x in v) for l, v in got.items()}
    want = lambda texts: sorted(language_id.symbols(t).tobytes() for t in set(texts))
    assert set(held) == {"copied", "own", "tiny", "long"}
    assert held["copied"] == want(copies) and held["tiny"] == want(tiny) and held["own"] == want(own)
    assert len(held["long"]) == 2 and sum(map(len, held["long"])) > language_id.LONGEST


def test_a_rare_class_is_fitted(spark):
    prepare(spark)
    rng.seed(0)  # no rare row among the sixty chosen from all rows together
    rows = [(i, say(20, "abcd"), 1) for i in range(3000)] + [(3000 + i, say(20, "wxyz"), 0) for i in range(4)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    new = spark.createDataFrame([(1, say(20, "wxyz")), (2, say(20, "abcd"))], "doc_id long, text string")
    for flip in (False, True):
        model = quality_classifier.fit(docs, labels.withColumn("quality", 1 - F.col("quality")) if flip else labels, rows=60)
        got = {r.doc_id: r._score >= 0.5 for r in quality_classifier.score(new, model).collect()}
        assert got == {1: flip, 2: not flip}


def test_repeated_benchmark_rows_do_not_fill_a_block(spark, monkeypatch):
    prepare(spark)
    line, sizes, build = say(12), [], decontaminate.Index.__init__

    def counted(self, items, window):
        sizes.append(sum(len(t or "") for _, t in items))
        build(self, items, window)
    monkeypatch.setattr(decontaminate.Index, "__init__", counted)
    bench = spark.createDataFrame([(1, line)] * 400 + [(2, line), (3, say(15)), (4, None), (4, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, say(5) + " " + line), (2, say(30))], "doc_id long, text string")
    got = {r.doc_id: (r._n_hit, r._n_items) for r in decontaminate.contamination(docs, bench, block_bytes=1000).collect()}
    assert got == {1: (12, 2), 2: (0, 0)} and sum(sizes) < 1000


def test_pairs_of_hashes_are_compared_as_pairs():
    gen = np.random.default_rng(1)
    h, h2 = (gen.integers(0, 6, 300, dtype=np.uint64) for _ in range(2))
    p, p2 = (gen.integers(0, 6, 20, dtype=np.uint64) for _ in range(2))
    held = set(zip(p.tolist(), p2.tolist()))
    assert suffix_dedup._among(h, h2, p, p2).tolist() == [x in held for x in zip(h.tolist(), h2.tolist())]
    assert not suffix_dedup._among(h, h2, p[:0], p2[:0]).any() and not len(suffix_dedup._among(h[:0], h2[:0], p, p2))
    # pairs that one folded 64-bit value cannot tell apart
    a, b, c = (np.array([x], np.uint64) for x in (5, 6, 9))
    third = np.array([pow(3, -1, 1 << 64)], np.uint64)
    other = a + (suffix_dedup.bytehash.mix(b) - suffix_dedup.bytehash.mix(c)) * third
    assert not suffix_dedup._among(other, c, a, b).any()
