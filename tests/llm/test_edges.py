"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing extra columns."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from ledgerline.llm import (chat_format, decontaminate, quality_classifier, quality_rules, sentencepiece_codec,
                            simhash_dedup, substring_dedup, token_counts)
from ledgerline.llm import queries as q
from ledgerline.llm.common import Memory, prepare
from ledgerline.llm.merge_rounds import PairTable, merge

rng = random.Random(21)
say = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))
LONG = say(60_000)
LINE = say(12)
ROWS = [(None, None), (None, "x"), (1, ""), (2, " \t\n"), (3, LINE + "\n" + say(20)), (4, say(9) + "\n" + LINE), (5, LONG),
        (6, LINE), (6, LINE), (6, LINE), (7, "# $ " * 40), (8, say(300)), (9, "<|endoftext|>▁ \x00é́ <|im_end|>")]
CLASH = ["tk", "t", "n_words", "_score", "_hit", "fp", "chunk", "row", "key", "id", "digest"]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    for n, c in enumerate(CLASH):
        df = df.withColumn(c, F.lit(n if n % 2 else f"v{n}"))
    return df.select(*CLASH[:4], "text", "doc_id", *CLASH[4:])


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(3, 1), (4, 1), (8, 1), (7, 0), (7, 0), (None, 1), (5, None), (6, 0), (6, 1), (9, 5)]
    return spark.createDataFrame([(i, v, "z") for i, v in rows], "doc_id long, quality int, good string")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, LINE), (1, LINE), (2, LINE.upper()), (3, None), (4, ""), (None, LINE), (5, "X"), (6, " ".join(LONG.split()[500:540]))]
    return spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id long, text string, doc_id int")


def by(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_op1(docs):
    out = substring_dedup.op1(docs)
    rows = {(r.doc_id, r.text): r for r in out.collect()}
    assert out.count() == len(ROWS) and rows[(None, None)].n_removed == 0
    assert all(rows[(i, t)].n_removed == 0 for i, t in ROWS if i in (3, 5, 6, 8))  # no run, or first, or no earlier copy
    assert substring_dedup.op1(docs.limit(0)).count() == 0


def test_op1_passages_inside_lines(spark):
    prepare(spark)
    a, b, c = (" ".join(x.capitalize() + "." for x in (say(9), say(8), say(12))) for _ in range(3))
    stock = say(11) + "."
    rows = [(1, f"{say(5)} {a}  {b}\n{stock}"), (2, f"{say(7)} {a.upper()} \n {b} {say(6)}. End"), (3, f"{stock}\n{say(30)}"),
            (4, "Yes. no"), (5, "yes.\n NO "), (5, "yes.\n NO "), (6, "yes. no more"), (7, f"{c} {say(3)}\n{c}"), (8, c), (9, c)]
    got = {r.doc_id: r for r in substring_dedup.op1(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    text = dict(rows)
    assert all(got[i].text == text[i] and got[i].n_removed == 0 for i in (1, 3, 4, 6))   # first places, a stock line, others
    start, stop = text[2].index(a.upper()[20:]) + len(a) - 20, text[2].index("End")
    assert got[2].n_removed >= 5 and got[2].first_doc_id == 1 and got[2].text.endswith(text[2][text[2].rindex(". ", 0, stop - 2) + 2:])
    assert len(got[2].text.split()) <= len(text[2].split()) - 45 and start < stop
    spans = [tuple(map(int, x.split("-"))) for x in got[2].removed.split(",")]
    left, at = "", 0
    for x, y in spans:                                                                   # original offsets give the kept text
        left, at = left + text[2][at:x], y
    assert left + text[2][at:] == got[2].text and sum(y - x for x, y in spans) == got[2].removed_chars
    assert got[5].text == "" and got[5].first_doc_id == 4 and got[7].text.count(c) == 1 and got[8].text == got[9].text == ""


def test_op2_op6(docs):
    import sentencepiece
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(q.tokenizer(q.WORD_BPE))
    want = sorted(((i, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS), key=str)
    assert by(token_counts.op2(docs, q.tokenizer(q.WORD_BPE)), "doc_id", "n_bytes", "n_tokens") == want
    sp = sentencepiece.SentencePieceProcessor(model_file=q.tokenizer(q.PIECE_BPE))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = sorted(((i, len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids))) for i, ids in ((i, sp.encode(t or "")) for i, t in ROWS)), key=str)
    assert by(sentencepiece_codec.op6(docs, q.tokenizer(q.PIECE_BPE)), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert token_counts.op2(docs.limit(0), q.tokenizer(q.WORD_BPE)).count() == 0
    assert sentencepiece_codec.op6(docs.limit(0), q.tokenizer(q.PIECE_BPE)).count() == 0


def test_tokenizers_on_odd_texts():
    import sentencepiece
    from tokenizers import Tokenizer
    lib, own = Tokenizer.from_file(q.tokenizer(q.WORD_BPE)), token_counts.Vocabulary(q.tokenizer(q.WORD_BPE))
    sp, codec = sentencepiece.SentencePieceProcessor(model_file=q.tokenizer(q.PIECE_BPE)), sentencepiece_codec.Codec(q.tokenizer(q.PIECE_BPE))
    pool = ["<|startoftext|>", "<|endoftext|>", "İ", "ΑΣ", "ẞ", "'s", "'S", "  ", "\xa0", "\x85", "\x1c", " ", "é", "日本", "½", "a", "The",
            "ing", "12", "!!", "\x00", "\U0001F600", "▁", "\n", "\t", "<s>", "<0x41>", "er", "n", " ", "aaaa"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(1500)] + ["a" * 3000, "thing" * 900]
    assert own.totals(texts) == [len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]
    n, ids, said = codec.encode_all(texts)
    for t, a, b, c in zip(texts, n, ids, said):
        want = sp.encode(t)
        assert (a, b, c) == (len(want), ",".join(map(str, want)), sp.decode(want)), t


def test_merge_rounds_equal_one_merge_at_a_time():
    def slow(word, ranks):
        while True:
            found = [(ranks[p], i) for i, p in enumerate(zip(word, word[1:])) if p in ranks]
            if not found:
                return word
            (r, i) = min(found)
            word = word[:i] + [100 + r] + word[i + 2:]
    for _ in range(40):
        ranks, made = {}, list(range(4))
        for r in rng.sample(range(30), 30):       # ranks in any order: later merges may outrank earlier ones
            p = (rng.choice(made), rng.choice(made))
            if p not in ranks:
                ranks[p] = r
                made.append(100 + r)
        table = PairTable([a for a, _ in ranks], [b for _, b in ranks], [100 + r for r in ranks.values()], list(ranks.values()))
        words = [[rng.randrange(4) for _ in range(rng.randint(1, 25))] for _ in range(60)]
        symbols, lengths = merge(np.array(sum(words, [])), np.array([len(w) for w in words]), table)
        got = [list(x) for x in np.split(symbols, np.cumsum(lengths)[:-1])]
        assert got == [slow(w, ranks) for w in words]


def test_memory_keeps_answers_right_when_full():
    m = Memory(8, short=3)
    for _ in range(50):
        keys = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 5))) for _ in range(6)}
        got = m.fill(keys, lambda new: [k * 2 for k in new])
        assert all(got[k] == k * 2 for k in keys) and len(m.now) + len(m.old) <= 24


def test_op3(docs, labels):
    out = quality_classifier.op3(docs, labels)
    got = by(out, "doc_id", "held_out", "score", "predicted")
    assert len(got) == len(ROWS) and all(0 <= r[2] <= 1 and r[3] == int(r[2] >= 0.5) for r in got)
    assert len({r[2] for r in got if r[0] == 6}) == 1
    assert quality_classifier.op3(docs.limit(0), labels).count() == 0
    none = quality_classifier.op3(docs, labels.limit(0)).select("score").distinct().collect()
    assert [r.score for r in none] == [0.5]
    one = quality_classifier.op3(docs, labels.where("quality = 1 and doc_id = 8")).select("predicted").distinct().collect()
    assert [r.predicted for r in one] == [1]


def test_op3_sample_is_bounded_in_places_and_blind_to_ids(spark):
    prepare(spark)
    rows = [(i, say(300) if i % 2 else say(300).upper(), i % 2 == 1) for i in range(60)]
    train = spark.createDataFrame(rows, "id long, t string, good boolean").repartition(4)
    found, label = quality_classifier.sample(train, 100, 30, 30)
    few, their = quality_classifier.sample(train, 100, 30, 30, most_places=sum(map(len, found)) // 3)
    assert len(found) == 60 and sum(map(len, few)) <= sum(map(len, found)) // 3 + 2 * max(map(len, found))
    assert set(their) == {1, -1} and abs(int(their.sum())) <= 2
    again, marks = quality_classifier.sample(train.withColumn("id", -F.col("id")), 100, 30, 30)
    assert (marks == label).all() and all((x == y).all() for x, y in zip(found, again))


def test_clashing_columns_are_refused_or_kept(spark, docs, labels, benchmark):
    model = quality_classifier.fit(docs, labels)
    for call, made in ((lambda d: quality_classifier.score(d, model), "_score"), (lambda d: decontaminate.contamination(d, benchmark), "_n_hit"),
                       (substring_dedup.dedup, "_removed"), (lambda d: token_counts.token_counts(d, q.tokenizer(q.WORD_BPE)), "_n_tokens")):
        plain = docs.drop("_score")
        with pytest.raises(ValueError, match=made):
            call(plain.withColumn(made, F.lit(1)))
        kept = plain.withColumns({c: F.lit("x") for c in ("_hit", "_row_tk", "gone", "_tk", "marks", "cut", "made", "tk2")})
        out = call(kept)
        assert out.columns[:len(kept.columns)] == kept.columns and out.count() == len(ROWS)
        assert out.where("_hit = 'x' and marks = 'x' and _row_tk = 'x'").count() == len(ROWS)


def test_op3_descent_reaches_the_dual_optimum():
    gen = np.random.default_rng(0)
    found = [np.flatnonzero(gen.random(12) < 0.5) for _ in range(40)]
    ratio, label = gen.normal(size=12), np.where(gen.random(40) < 0.5, 1, -1)
    w, b = quality_classifier.descend(found, label, ratio, epochs=400, cost=0.7)
    rows = np.zeros((40, 13))
    for i, f in enumerate(found):
        v = ratio[f] / (np.linalg.norm(ratio[f]) or 1)
        rows[i, f], rows[i, 12] = v, 1
    top = np.array([0.7 * 40 / (2 * (label == s).sum()) for s in label])

    def primal(x):
        return x @ x / 2 + (top * np.maximum(0, 1 - label * (rows @ x))).sum()
    best = np.r_[w, b]
    for _ in range(300):
        assert primal(best) <= primal(best + gen.normal(scale=0.05, size=13)) + 1e-6


def test_op5(docs, spark):
    rows = {r.doc_id: r for r in quality_rules.op5(docs).collect()}
    assert quality_rules.op5(docs).count() == len(ROWS) and quality_rules.op5(docs.limit(0)).count() == 0
    assert (rows[1].n_words, rows[1].base_failed, rows[1].kept) == (0, True, False)
    assert rows[7].n_symbols == 80 and not rows[7].kept and rows[8].kept and rows[5].n_words == 60_000
    df = spark.createDataFrame([(1, " ".join(str(i % 7) for i in range(70))), (2, " ".join(f"w{i // 2 % 200} w{i // 2 % 200 + 1} q" for i in range(900)))],
                               "doc_id long, text string")       # few repeated windows and many of them

    def repeats(t):
        w = t.split()
        g = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        return len({p for i, x in enumerate(g) if g.count(x) > 1 for p in (i, i + 1, i + 2)})
    assert {r.doc_id: r.n_repeat_words for r in quality_rules.op5(df).collect()} == {r.doc_id: repeats(r.text) for r in df.collect()}


def test_op5_ablations_equal_recounting(docs):
    led = quality_rules.ledger(docs).cache()
    masks = [r.failed_bits for r in led.collect()]
    for version, rules in quality_rules.POLICIES.items():
        whole = quality_rules.mask(rules)
        got = {r.rule: (r.n_failed, r.n_failed_alone, r.n_kept_without) for r in quality_rules.ablations(led, version).collect()}
        for rule in rules:
            bit = quality_rules.mask((rule,))
            assert got[rule] == (sum(m & bit != 0 for m in masks), sum(m & whole == bit for m in masks), sum(m & whole & ~bit == 0 for m in masks))


def test_op8(docs, benchmark):
    got = by(decontaminate.op8(docs, benchmark), "doc_id", "n_words", "n_hit", "n_items", "items_sha256")
    sha = lambda *i: hashlib.sha256(",".join(sorted(map(str, i))).encode()).hexdigest()
    rows = {(r[0], r[1]): r for r in got}
    assert rows[(3, 32)][2:] == (12, 2, sha(1, 2)) and rows[(6, 12)][2:] == (12, 2, sha(1, 2))
    assert rows[(5, 60_000)][2:] == (40, 1, sha(6)) and rows[(None, 1)][2:] == (1, 1, sha(5)) and rows[(None, 0)][2:] == (0, 0, sha())
    blocks = decontaminate.contamination(docs.select("doc_id", "text"), benchmark, block_bytes=100)
    assert by(blocks, "doc_id", "_n_words", "_n_hit", "_n_items", "_items_sha256") == got
    assert decontaminate.op8(docs.limit(0), benchmark).count() == 0
    assert decontaminate.op8(docs, benchmark.limit(0)).where("contaminated").count() == 0


def test_op8_textual_ids_and_block_memory(spark, docs):
    import pickle
    bench = spark.createDataFrame([("b-2", LINE), ("a", LINE)], "item_id string, text string")
    got = {r.doc_id: r for r in decontaminate.op8(docs, bench).collect()}
    assert got[3].n_items == 2 and got[3].items_sha256 == hashlib.sha256(b"a,b-2").hexdigest()
    items = [(str(n), say(150)) for n in range(1500)]
    size = sum(len(t) for _, t in items)
    assert len(pickle.dumps(decontaminate.Index(items))) < 16 * size and decontaminate.BLOCK_BYTES * 60 < 300e6


def test_op9(spark):
    said = [(1, 1, "user", "a<|im_end|>\\n\\b\\p<\\p"), (1, 2, "assistant", None), (1, 2, "assistant", "x"), (1, None, "system", ""), (None, 1, None, "q\nr"),
            (2, 1, "ro\nle\\n<|", "<|im_start|>"), (3, 5, "user", LONG), (3, 6, "assistant", LONG), (3, 6, "assistant", LONG), (4, 1, "assistant", "z")]
    df = spark.createDataFrame(said, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)).withColumn("segments", F.lit("s"))
    got = {r.conv_id: r for r in chat_format.op9(df).collect()}
    rows = [*said, (-1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok")]
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        own = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        loss = "".join(x[3] for x in own if x[2] == "assistant")
        assert r.n_turns == len(own) and r.loss_chars == len(loss) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.turns_sha256 == hashlib.sha256("".join(f"{x[2]}\n{x[3]}\n" for x in own).encode()).hexdigest()
    assert [got[c].valid for c in (-1, 1, 2, 3, 4)] == [True, False, False, False, False]
    assert [r.conv_id for r in chat_format.op9(df.limit(0)).collect()] == [-1]


def test_op9_other_templates(spark):
    inst = (("literal", "[INST] "), ("role", ""), ("literal", ": "), ("text", ""), ("literal", " [/INST]"))
    open_end = (("literal", "=> "), ("role", ""), ("literal", "\n"), ("text", ""))
    said = ["[INST] x [/INST]", "a: b [/INST", "\\c\\d\\b", "=> user\n=", " [INST", "", "[/INST] ", "x\\"]
    rows = [(c, n, said[(c + n) % 8] if n % 3 else "assistant", said[(c * 3 + n) % 8]) for c in range(8) for n in range(6)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for template in (chat_format.TEMPLATE, inst, open_end):
        for r in chat_format.read_back(chat_format.format_chat(df, template), template).collect():
            own = [x for x in rows if x[0] == r.conv_id]
            assert [(t.role, t.text) for t in r.turns] == [x[2:] for x in own]
            assert r.loss_text == "".join(x[3] for x in own if x[2] == "assistant")
            assert r.formatted.count(template[0][1]) == 6
    for bad in ((("role", ""), ("text", "")), (("literal", "aba"), ("role", ""), ("literal", "ab"), ("text", "")),
                (("literal", "<"), ("role", ""), ("text", ""))):
        with pytest.raises(ValueError):
            chat_format.Template(bad)
    lone = spark.createDataFrame([(None, 1, "user", "a"), (None, 2, "user", "b")], "conv_id long, turn long, role string, text string")
    assert sorted(r.n_turns for r in chat_format.op9(lone).collect()) == [1, 1, 2]


def test_pipeline_stages_equal_brute_force(spark, docs, labels, benchmark, tmp_path):
    from tests.llm.test_simhash import brute
    sf = f"file://{tmp_path}"
    labels.write.parquet(f"{sf}/labels.parquet")
    benchmark.write.parquet(f"{sf}/benchmark.parquet")
    names = docs.columns
    held = docs.where(~quality_classifier.held_out(F.col("doc_id")))
    scored = quality_classifier.score(docs.drop("_score"), quality_classifier.fit(held, labels))
    out = cp.quality(spark, docs, sf)
    assert out.columns == names and by(out, "doc_id", "text") == by(scored.where("_score >= 0.5"), "doc_id", "text")

    out = cp.near_dedup(spark, docs, sf)
    group = {i: brute({i: t})[i][0] for i, t in enumerate(t for _, t in ROWS)}
    links = brute({n: t for n, (_, t) in enumerate(ROWS)})
    components = {links[n][1] for n in group}
    assert out.columns == names and out.count() == len(components)
    best = {c: min((i is None, i or 0) for n, (i, _) in enumerate(ROWS) if links[n][1] == c) for c in components}
    assert sorted(((r.doc_id is None, r.doc_id or 0) for r in out.collect())) == sorted(best.values())

    out = cp.line_dedup(spark, docs, sf)
    assert out.columns == names and by(out, "doc_id", "text") == by(substring_dedup.op1(docs), "doc_id", "text")
    numbered = cp.line_dedup(spark, docs.withColumn("n_chars", F.length("text").cast("long")), sf)
    assert numbered.where("text is not null and n_chars <> length(text)").count() == 0

    out = cp.decontamination(spark, docs, sf)
    clean = {r.doc_id for r in decontaminate.op8(docs, benchmark).where("not contaminated").collect()}
    assert out.columns == names and {r.doc_id for r in out.collect()} == clean

    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=q.tokenizer(q.PIECE_BPE))
    out = cp.encoding(spark, docs, sf)
    assert sorted(([r.doc_id, r.ids] for r in out.collect()), key=str) == sorted(([i, sp.encode(t or "")] for i, t in ROWS), key=str)


def test_pipeline_runs_whole_and_on_empty_tables(spark, docs, labels, benchmark, tmp_path):
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", benchmark)):
        df.write.parquet(f"file://{tmp_path}/a/{name}.parquet")
        df.limit(0).write.parquet(f"file://{tmp_path}/b/{name}.parquet")
    assert cp.run(spark, f"file://{tmp_path}/a").columns[0] == "doc_id"
    assert cp.run(spark, f"file://{tmp_path}/b").count() == 0
    assert [f.__name__ for _, f in cp.STAGES] == ["quality", "near_dedup", "line_dedup", "decontamination", "encoding"]
    again = docs.withColumn("_n_hit", F.lit(2)).withColumn("rest", F.lit("r"))
    for stage in (cp.quality, cp.near_dedup, cp.line_dedup, cp.decontamination):
        out = stage(spark, again, f"file://{tmp_path}/a")
        assert out.columns == again.columns and out.where("rest <> 'r' or _n_hit <> 2").count() == 0
    assert simhash_dedup.keepers(simhash_dedup.near_duplicates(docs.limit(0))).count() == 0
