"""Op 13 against brute force: every pair of sets compared, components by union-find."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import superminhash_dedup as sm
from ledgerline.llm.common import prepare, table


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())


def brute(rows):
    """(doc_id, set size, component, kept) of rows (doc_id, text)."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    holders = {}
    for n, own in enumerate(sets):
        common = {}
        for g in own:
            for o in holders.setdefault(g, []):
                common[o] = common.get(o, 0) + 1
            holders[g].append(n)
        for o, both in common.items():
            if 100 * both >= 80 * (len(own) + len(sets[o]) - both):
                root[find(n)] = find(o)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[find(n)] = min(i, least.get(find(n), i))
    return sorted(((i, len(s), least.get(find(n)), i == least.get(find(n))) for n, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def answer(df):
    return sorted((tuple(r) for r in sm.op13(df).collect()), key=str)


def test_whole_table(spark):
    prepare(spark)
    df = table(spark, "/root/testdata/sf0.01", "documents")
    assert answer(df) == brute([tuple(r) for r in df.select("doc_id", "text").collect()])


def near_copies(rng, group=120):
    """A group whose copies mostly link with its original only, chains, and boundary pairs."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    base, texts = [word() for _ in range(200)], []
    for _ in range(group):
        own = list(base)
        for _ in range(rng.randint(0, 7)):
            own[rng.randrange(200)] = word()
        texts.append(" ".join(own))
    chain = [word() for _ in range(60)]
    for n in range(0, 30, 2):
        chain = [word() if k == n else w for k, w in enumerate(chain)]
        texts.append(" ".join(chain))
    short = [word() for _ in range(13)]                # sets of ten: eight of ten in common is a link
    texts += [" ".join(short), " ".join(short[1:]), " ".join(short[2:]), " ".join(short[:-2]), " ".join(short[4:])]
    return texts


def test_groups_of_near_copies(spark, monkeypatch):
    prepare(spark)
    rng = random.Random(6)
    texts = [t for _ in range(2) for t in near_copies(rng)]
    texts += ["", None, " \n", "one", "ONE", "one two three", texts[3], texts[3].upper(), "x " * 5000]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(None, "one"), (None, "only here once"), (5, "five again"), (5, "five again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for c in ("n", "sid", "keys", "label", "t", "place", "hub"):
        df = df.withColumn(c, F.lit(c))
    want = brute(rows)
    assert answer(df) == want
    monkeypatch.setattr(sm, "BLOCK", 500)              # a group over many blocks and chunks
    monkeypatch.setattr(sm, "CHUNK", 700)
    assert answer(df) == want
    assert answer(df.limit(0)) == []


def test_signatures_are_those_of_sequential_superminhash():
    """The ranks dealt side by side equal those of dealing each element's whole permutation by itself."""
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (1, 2, 7, 40, 300)]
    got = sm.signatures(sets, 16)
    for own, sig in zip(sets, got):
        least = [1 << 64] * 16
        for e in own:
            order = list(range(16))
            for rank in range(16):
                draw = int(sm.spread(np.array([e]) + np.uint64(int(sm.STEP) * (rank + 1) % (1 << 64)))[0])
                pick = rank + ((draw & 0xFFFFFFFF) * (16 - rank) >> 32)
                order[rank], order[pick] = order[pick], order[rank]
                least[order[rank]] = min(least[order[rank]], rank << 32 | draw >> 32)
        assert sig.tolist() == least


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    found = [(sm.signatures([pool[a:a + 100], pool[a + 20:a + 120]]), 80 / 120) for a in range(0, 800, 8)]
    shares = [(s[0] == s[1]).mean() for s, _ in found]
    assert abs(np.mean(shares) - 80 / 120) < 0.01 and np.std(shares) < (2 / 9 / 128) ** 0.5


@pytest.mark.parametrize("text, size", [("", 0), (" \t", 0), ("A b", 1), ("a b c d", 1), ("a b c d e a b c d", 5), ("é é é é é", 1)])
def test_shingle_sets(text, size):
    one, two = sm.shingle_sets(pa.array([text, text.replace(" ", "\n ").upper() if text.isascii() else text]))
    assert len(one) == size and (one == two).all()
