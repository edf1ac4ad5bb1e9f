import random

import numpy as np
import xxhash
from pyspark.sql import Row

from ledgerline.llm import simhash_dedup as s
from ledgerline.llm.common import prepare


def brute(texts, radius=2, passes=None):
    def fp(t):
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for c in "\t\n\x0b\x0c\r":
            w = w.replace(c, " ")
        w = [x for x in w.split(" ") if x]
        if not w:
            return 0
        sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
        hs = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    fps = {d: fp(t) for d, t in texts.items()}
    comp = {d: d for d in texts}
    near = [(a, b) for a in texts for b in texts if a < b and bin(fps[a] ^ fps[b]).count("1") <= radius]
    for _ in range(passes or len(texts)):
        for a, b in near:
            comp[a] = comp[b] = min(comp[a], comp[b])
    return {d: (f"{fps[d]:016x}", comp[d]) for d in texts}


def test_fingerprints_and_components_match_brute_force(spark):
    prepare(spark)
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "né", " x", "tail"]
    texts = {0: None, 1: "", 2: " \t\n", 3: "one", 4: "one two", 5: "ONE two"}
    for i in range(10, 40):
        texts[i] = " ".join(rng.choice(words) for _ in range(rng.randint(1, 400)))
    for i in range(40, 70):
        base = texts[rng.randint(10, 39)].split(" ")
        base[rng.randrange(len(base))] = rng.choice(words)
        texts[i] = "  ".join(base)
    texts[99] = "long " * 50000
    df = spark.createDataFrame([Row(doc_id=d, text=t, component_id="clash", fp=1) for d, t in texts.items()])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in s.op10(df).collect()}
    assert got == brute(texts)


def test_roots_bit_sliced_equals_pairs():
    rng = np.random.default_rng(3)
    for n in (2, 3, 63, 64, 65, 300):
        base = rng.integers(0, 1 << 63, 1, dtype=np.uint64)
        flips = np.zeros(n, np.uint64)
        for _ in range(5):
            flips ^= np.uint64(1) << rng.integers(0, 24, n).astype(np.uint64)
        fps = np.unique(base ^ flips)
        root = s.roots(fps)
        label = np.arange(len(fps))
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
        for _ in range(len(fps)):
            label = np.array([label[near[i]].min() for i in range(len(fps))])
        assert (root == label).all()


def test_hot_groups_are_dealt_again_with_the_same_result(spark):
    prepare(spark)
    rng = np.random.default_rng(4)
    fps = np.unique(np.r_[(np.uint64(7 << 40) ^ rng.integers(0, 1 << 14, 300).astype(np.uint64)),
                          rng.integers(0, 1 << 63, 50, dtype=np.uint64)]).view(np.int64)
    df = spark.createDataFrame([Row(doc_id=i, fp=int(f)) for i, f in enumerate(fps)])
    one = {r.fp: r.component_id for r in s.groups(df, hot=8).collect()}
    two = {r.fp: r.component_id for r in s.groups(df, hot=10**6).collect()}
    assert one == two and len(one) == len(fps)


def test_empty_table_null_ids_and_repeated_rows(spark):
    prepare(spark)
    df = spark.createDataFrame([], "doc_id long, text string")
    assert s.op10(df).count() == 0
    df = spark.createDataFrame([(None, "a b c d"), (None, None), (7, "a b c d"), (7, "a b c d")], "doc_id long, text string")
    rows = sorted((str(r.doc_id), str(r.component_id)) for r in s.op10(df).collect())
    assert rows == [("7", "7"), ("7", "7"), ("None", "7"), ("None", "None")]
