import random

import numpy as np

from ledgerline.llm import language_id as li
from ledgerline.llm.common import prepare


def parse(text: bytes, sample: list[bytes]) -> int:
    count, i = 0, 0
    while i < len(text):
        n = 1
        while i + n < len(text) and any(text[i:i + n + 1] in s for s in sample):
            n += 1
        count, i = count + 1, i + n
    return count


def test_phrases_equal_brute_force():
    rng = random.Random(2)
    word = lambda a: "".join(rng.choice(a) for _ in range(rng.randint(1, 6)))
    said = lambda a, n: " ".join(word(a) for _ in range(n))
    samples = {"x": [said("abc", 60), said("abcé", 40), said("abc", 60)[:50]], "y": [said("bcdö", 80)], "z": ["abab abab"]}
    model = li.Model.learn({k: [li.symbols(t) for t in v] for k, v in samples.items()})
    texts = ["", "a", "q", "zzz qq", said("abcd", 900), said("abcéö", 1500), said("ab", 4)]
    got = model.phrases([li.symbols(t) for t in texts])
    for i, t in enumerate(texts):
        raw = li.symbols(t).tobytes()
        for k, name in enumerate(model.names):
            own = [li.symbols(s).tobytes() for s in samples[name]]
            assert got[i, k] == sum(parse(raw[a:a + li.BLOCK], own) for a in range(0, len(raw), li.BLOCK)), (t[:20], name)


def test_a_language_takes_under_two_megabytes():
    rng = random.Random(8)
    word = lambda a: "".join(rng.choice(a) for _ in range(rng.randint(1, 8)))
    samples = {}
    for n, a in enumerate(("abcdefghijklmnopqrstuvwxyzäöüß", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "".join(map(chr, range(0x4E00, 0x4F00))))):
        text = li.symbols(" ".join(word(a) for _ in range(12_000)))
        samples[f"l{n}"] = [text[:li.SAMPLE_SYMBOLS]]
    model = li.Model.learn(samples)
    assert model.size() / len(samples) < 2e6
    texts = [v[0][:3000] for v in samples.values()]
    assert (model.phrases(texts).argmin(1) == np.arange(3)).all()


def test_query_learns_and_covers_odd_rows(spark):
    prepare(spark)
    rng = random.Random(3)
    say = lambda a: " ".join("".join(rng.choice(a) for _ in range(5)) for _ in range(40))
    rows = [(i, say("abcde") if i % 2 else say("vwxyz"), "aa" if i % 2 else "vv") for i in range(80)]
    rows += [(100, None, "aa"), (101, "12 !!", "aa"), (102, "", None), (None, "abc", None), (1, rows[1][1], "aa"), (103, "abcde " * 60000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as lang_pred", "2 as score")
    out = {(r.doc_id, r.lang_pred) for r in li.op7(df).collect()}
    assert {(100, "und"), (101, "und"), (102, "und"), (None, "aa"), (103, "aa")} <= out
    assert all((i, "aa" if i % 2 else "vv") in out for i in range(80))
    assert li.op7(df.limit(0)).count() == 0
    assert {r.lang_pred for r in li.op7(df.withColumn("lang", df.lang.substr(9, 1)).where("lang is null")).collect()} == {"und"}
    assert np.isfinite([r.score for r in li.op7(df).collect()]).all()
