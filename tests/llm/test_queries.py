"""The registered queries over the whole small tables against brute force, libraries or SQL."""

import hashlib
import zlib

import pytest
from tests.conftest import SF_SMALL
from tests.oracle import compare

import __spark_entry__ as entry
from ledgerline.llm import queries as q


def documents(duck):
    return duck.execute("select doc_id, text from documents order by doc_id").fetchall()


def rows(spark, name):
    return {r[0]: r for r in q.queries()[name](spark, SF_SMALL).collect()}


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_oracle(spark, duck, name):
    info = compare(spark, duck, name, q.queries()[name], q.oracle_sql()[name], SF_SMALL, pandas_check=True)
    assert info["ok"] and info["pandas_ok"] and "type_mismatch" not in info, info


def test_op2_equals_the_library(spark, duck):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(q.tokenizer(q.WORD_BPE))
    got = rows(spark, "op2_token_counts")
    for i, t in documents(duck):
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        assert tuple(got[i]) == (i, len((t or "").encode()), n, n > 2048)


def test_op6_equals_the_library(spark, duck):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=q.tokenizer(q.PIECE_BPE))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = rows(spark, "op6_sentencepiece")
    for i, t in documents(duck):
        ids = lib.encode(t or "")
        assert tuple(got[i]) == (i, len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids)))


def test_op4_equals_brute_force(spark, duck):
    from tests.llm.test_suffix_dedup import brute

    got = rows(spark, "op4_suffix_array_dedup")
    assert sorted(tuple(r) for r in got.values()) == brute(documents(duck))


def test_op10_equals_brute_force(spark, duck):
    from tests.llm.test_simhash import brute

    got = rows(spark, "op10_simhash_near_dedup")
    want = brute(dict(documents(duck)), passes=8)
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == want


@pytest.mark.parametrize("name,mod,rest,label", [("op3_quality_classifier", 3, 1, "quality"), ("op7_language_id", 4, 2, "lang")])
def test_held_out_accuracy(spark, duck, name, mod, rest, label):
    got = rows(spark, name)
    truth = dict(duck.execute("select doc_id, quality from labels" if label == "quality" else "select doc_id, lang from documents").fetchall())
    assert len(got) == len(documents(duck))
    held = {i for i in got if zlib.crc32(str(i).encode()) % mod == rest}
    assert {i for i, r in got.items() if r.held_out} == held
    assert all(0 <= r.score <= 1 for r in got.values())
    judged = [(got[i][3 if label == "quality" else 2], truth[i]) for i in held if i in truth]
    assert sum(a == b for a, b in judged) >= 0.9 * len(judged)
