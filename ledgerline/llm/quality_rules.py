"""Quality rules as a bitmask ledger (DataFrame functions only).

Every rule is measured once per document; a failed rule sets its bit in ``failed_bits``.
Policies are versioned bit masks over the ledger: a document is kept when none of the policy's
bits is set.  Ablations (what each rule alone costs a policy) come from counts per distinct bit
mask, a small table, by bitwise tests; the texts are not read again.

Words are ``[^\\x20\\x09-\\x0D]+``.  Null or empty text: zero words, which fails the word rule.
Repeated rows and ids are judged row by row.  Extra columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = r"[ \t-\r]+"
SYMBOL = r"[#*$%&|<>]"

#: Rule name -> failing condition over the measurements; the position is the bit number.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "n_lines >= 4 and 2 * n_dup_lines > n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 16 * n_words",
    "capitals": "5 * n_capitals > 2 * word_chars",
}
#: Policy version -> rules it enforces.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v2": tuple(RULES),
}


def mask(rules: tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Measurements and ``failed_bits`` of every row: key, n_words, word_chars, n_symbols,
    n_lines, n_dup_lines, n_repeat_words, n_capitals, failed_bits."""
    df = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    df = df.select(
        "doc_id", "t",
        F.array_remove(F.split("t", SPACE), "").alias("w"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^ \t-\r]")).alias("lines"),
    )
    df = df.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.regexp_count("t", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("""case when size(w) >= 3
                  then transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2]))
                  else cast(array() as array<bigint>) end""").alias("grams"),
    )
    kept = [c for c in df.columns if c != "grams"]
    # windows sorted by hash; equal neighbours are the repeated ones
    df = df.select(*kept, "grams", F.expr("""case when size(array_distinct(grams)) = size(grams)
        then cast(array() as array<bigint>) else sort_array(grams) end""").alias("s"))
    df = df.select(*kept, "grams", F.expr("""array_distinct(transform(
        filter(sequence(1, greatest(size(s) - 1, 1)), i -> size(s) > 1 and s[i] = s[i - 1]),
        i -> s[i]))""").alias("dups"))
    # positions of the repeated windows, ascending; by lookup or, where there are many, by sorting
    df = df.select(*kept, F.expr("""case
        when size(dups) = 0 then cast(array() as array<int>)
        when size(dups) <= 64 then filter(sequence(0, size(grams) - 1), i -> array_contains(dups, grams[i]))
        else null end""").alias("p"), F.expr("""case when size(dups) > 64
        then array_sort(transform(grams, (h, i) -> struct(h as h, i as i))) end""").alias("q"))
    df = df.select(*kept, F.expr("""coalesce(p, array_sort(transform(filter(sequence(0, size(q) - 1),
        i -> (i > 0 and q[i].h = q[i - 1].h) or (i < size(q) - 1 and q[i].h = q[i + 1].h)),
        i -> q[i].i)))""").alias("p"))
    df = df.select(*kept, F.expr("""aggregate(p, named_struct('last', -3, 'n', 0L),
        (a, x) -> named_struct('last', x, 'n', a.n + least(3, x - a.last)), a -> a.n)""").alias("n_repeat_words"))
    bits = F.lit(0).cast("long")
    for number, condition in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << number)).otherwise(0).cast("long"))
    return df.withColumn("failed_bits", bits)


def apply_policy(led: DataFrame, version: str = "v2", name: str = "kept") -> DataFrame:
    """Add the policy's verdict to a ledger."""
    return led.withColumn(name, F.col("failed_bits").bitwiseAND(F.lit(mask(POLICIES[version]))) == 0)


def ablations(led: DataFrame, version: str = "v2") -> DataFrame:
    """Per rule of a policy: documents failing it, failing it alone, and kept without it.

    Counts per distinct bit mask (at most 2^rules rows) come first; each rule is then a bit test."""
    rules = POLICIES[version]
    whole = mask(rules)
    by_mask = led.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    listed = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask((r,))).cast("long").alias("bit")) for r in rules])
    each = by_mask.select("failed_bits", "n", F.explode(listed).alias("r")).select("failed_bits", "n", "r.*")
    enforced = F.col("failed_bits").bitwiseAND(F.lit(whole).cast("long"))
    others = F.col("failed_bits").bitwiseAND(F.lit(whole).cast("long").bitwiseXOR(F.col("bit")))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    return each.groupBy("rule").agg(
        total(F.col("failed_bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(enforced == F.col("bit")).alias("n_failed_alone"),
        total(others == 0).alias("n_kept_without"),
    )


def op5(docs: DataFrame) -> DataFrame:
    """The contract's row per document: measurements, base verdict, verdict of policy v2."""
    led = apply_policy(apply_policy(ledger(docs), "base", "base_ok"), "v2", "kept")
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      (~F.col("base_ok")).alias("base_failed"), "kept", "failed_bits", "n_capitals", "n_lines")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t,
        list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
      FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
c AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
p AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM c) GROUP BY r),
m AS (SELECT w.r, doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_capitals,
        len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
        coalesce(p.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN p ON w.r = p.r),
b AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
        + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
        + CASE WHEN n_lines >= 4 AND 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
        + CASE WHEN word_chars < 2 * n_words OR word_chars > 16 * n_words THEN 16 ELSE 0 END
        + CASE WHEN 5 * n_capitals > 2 * word_chars THEN 32 ELSE 0 END)::BIGINT AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, failed_bits = 0 AS kept,
       failed_bits, n_capitals, n_lines
FROM b
"""
