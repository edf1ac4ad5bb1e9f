"""Training-data pipeline over ``documents``: five stages, each calling one operator of ``ledgerline.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next
one's ``docs``.  All but the last return the columns of their input, extra ones included; an input
column never clashes with an operator's, since the others travel as one struct.  Null or empty texts pass the
stages by the operators' rules: no n-grams (judged by the classifier's bias), fingerprint zero (one row
of that group stays), nothing to remove, no benchmark words, no tokens.  Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, quality_classifier, sentencepiece_codec, simhash_dedup, substring_dedup
from ledgerline.llm.common import prepare, stored, table, text_key
from ledgerline.llm.queries import PIECE_BPE, tokenizer


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the other columns as one struct; only texts go to Python."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*rest, F.lit(0).alias("_")).alias("rest"))


def _unpacked(rows: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of ``docs`` again, some of them changed."""
    own = lambda c: F.col(c) if c in ("doc_id", "text") else F.col(f"rest.`{c}`")
    return rows.select(*[changed.get(c, own(c)).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from labelled rows that are not held out."""
    prepare(spark)
    model = quality_classifier.fit(docs.where(~quality_classifier.held_out(F.col("doc_id"))), table(spark, sf_dir, "labels"))
    return _unpacked(quality_classifier.score(_packed(docs), model).where("_score >= 0.5"), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the smallest id (exact repeats of its row go too)."""
    prepare(spark)
    keep, _ = stored(simhash_dedup.keepers(simhash_dedup.near_duplicates(docs)), "pipeline-keepers")
    rows = _packed(docs).withColumns({"id": F.col("doc_id").cast("long"), "key": text_key(F.col("text"))})
    same = rows["id"].eqNullSafe(keep["doc_id"]) & (rows["key"] == keep["tk"])
    return _unpacked(rows.join(keep, same, "left_semi").dropDuplicates(["id", "key"]), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur earlier; n_chars follows the text."""
    prepare(spark)
    out = substring_dedup.dedup(_packed(docs))
    text = F.col("_kept_text")
    changed = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.size("_removed") > 0, F.char_length(text).cast(kind)).otherwise(F.col("rest.n_chars"))
    return _unpacked(out, docs, **changed)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    prepare(spark)
    out = decontaminate.contamination(_packed(docs), table(spark, sf_dir, "benchmark"))
    return _unpacked(out.where("_n_hit = 0"), docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256, decoded_sha256."""
    prepare(spark)
    out = sentencepiece_codec.encode(docs.select("doc_id", "text"), tokenizer(PIECE_BPE), carry=["doc_id"], ids=True)
    return out.select("doc_id", F.col("_n_tokens").alias("n_tokens"), F.col("_ids").alias("ids"),
                      F.col("_ids_sha256").alias("ids_sha256"), F.col("_decoded_sha256").alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", line_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", encoding),
]

#: The classifier, the fingerprints and the codec are not expressible in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written before the next reads it."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs, _ = stored(docs, f"pipeline-{number}")
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
