"""Quality classifier: a linear support vector machine on n-gram indicators scaled by naive Bayes
log-count ratios.

n-grams of a text, each an indicator in one of 2^17 hashed places: byte n-grams of one to four bytes,
and n-grams of two to six over the marks "this word equals the word before" / "it does not".  The ratio
of a place is log((1 + good documents with it) / (1 + all good)) less the same of the bad, counted over
every labelled training document (partial counts per task, then a sum per place).  Scaled vectors have
length one.  The hinge loss is minimised by dual coordinate descent on a sample of about ``FIT_ROWS``
different labelled texts and at most ``FIT_PLACES`` places, half of each class or all of a smaller one,
taken by a hash of the text (documented bounds of the driver's work and memory); both classes weigh the
same.  The score is the logistic of the margin.

Learned from rows with one non-null label 0 or 1; an id with both labels is left out; a null id has
none.  A null or empty text has no n-grams: its score is that of the bias.  With one class only, the
bias is that class; with none it is 0 (score 0.5).  Every row is scored by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytehash
from .common import crc_mod, drop_stored, held, refuse, slices, stored, text_key, utf8

BITS = 17
PLACES = 1 << BITS
FIT_ROWS, EPOCHS, COST, STEEPNESS, SEED = 3000, 12, 4.0, 3.0, 7
#: Places of the fitting sample together: 12 bytes each on the driver.
FIT_PLACES = 8 << 20
AT_ONCE = 1 << 20
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, *range(9, 14)]] = False


def _place(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h + np.uint32(salt * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    return (h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)


def features(column: pa.Array) -> Iterator[np.ndarray]:
    """Distinct places of each row's n-grams."""
    raw, rows = utf8(column)
    grams, gram = [], raw.astype(np.uint32)
    for n in range(1, 5):
        if n > 1:
            gram = (gram[:-1] << np.uint32(8)) | raw[n - 1:]
        grams.append(_place(gram, n))
    starts, stops, at = bytehash.words(raw, rows, NOT_SPACE)
    word = bytehash.PrefixHash(raw).of(starts, stops)
    marks, same = [], np.zeros(len(word), np.uint32)
    if len(word):
        same[1:] = word[1:] == word[:-1]
    gram = same
    for n in range(2, 7):
        gram = (gram[:-1] << np.uint32(1)) | same[n - 1:]
        marks.append(_place(gram, 16 + n))
    seen, order = np.zeros(PLACES, np.int32), np.arange(4096, dtype=np.int32)
    for row in range(len(rows) - 1):
        a, b, u, v = rows[row], rows[row + 1], at[row], at[row + 1]
        found = np.concatenate([g[a:max(a, b - n)] for n, g in enumerate(grams)]
                               + [m[u:max(u, v - n - 1)] for n, m in enumerate(marks)])
        if len(found) > len(order):
            order = np.arange(2 * len(found), dtype=np.int32)
        own = order[:len(found)]
        seen[found] = own
        yield found[seen[found] == own]


@dataclass
class Model:
    weight: np.ndarray  # of an indicator: ratio times the machine's weight
    square: np.ndarray  # squared ratio
    bias: float

    def margin(self, found: np.ndarray) -> float:
        size = float(self.square[found].sum())
        return self.bias + (float(self.weight[found].sum()) / size ** 0.5 if size else 0.0)


def logistic(margin: float) -> float:
    return 1 / (1 + float(np.exp(-min(max(STEEPNESS * margin, -500), 500))))


def labelled(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, t, good) of documents with one label."""
    one = labels.where(F.col("quality").isin(0, 1)).groupBy(F.col(key).alias("id")).agg(
        F.min("quality").alias("low"), F.max("quality").alias("high")).where("low = high").select(
        "id", (F.col("low") == 1).alias("good"))
    # a sort-merge join at every size: texts move once, as they must beyond a broadcast's bound
    return docs.select(F.col(key).alias("id"), F.col(text).alias("t")).join(one.hint("merge"), "id")


def ratios(train: DataFrame) -> tuple[np.ndarray, int, int]:
    """Log-count ratio of every place over all labelled documents, and the documents of each class."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("quality", dict)
        count = np.zeros((2, PLACES + 1), np.int64)  # the last place counts documents
        for batch in batches:
            for part in slices(batch, "t", AT_ONCE):
                names = part.schema.names
                good = part.column(names.index("good")).to_pylist()
                for found, g in zip(features(part.column(names.index("t"))), good):
                    count[int(g), found] += 1
                    count[int(g), PLACES] += 1
        some = np.flatnonzero(count.sum(0))
        yield pa.RecordBatch.from_pydict({"f": some, "bad": count[0, some], "good": count[1, some]})

    sums = train.select("t", "good").mapInArrow(each, "f long, bad long, good long").groupBy("f").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")).toArrow()  # one row per place at most
    count = np.zeros((2, PLACES + 1), np.int64)
    for k, name in enumerate(("bad", "good")):
        count[k, sums.column("f").to_numpy()] = sums.column(name).to_numpy()
    n = count[:, PLACES]
    share = np.log(count[:, :PLACES] + 1.0) - np.log(n[:, None] + 1.0)
    return (share[1] - share[0]) * (n.min() > 0), int(n[0]), int(n[1])


def sample(train: DataFrame, rows: int, bad: int, good: int, most_places: int = FIT_PLACES) -> tuple[list[np.ndarray], np.ndarray]:
    """Places and labels (+1, -1) of about ``rows`` different labelled texts, chosen and ordered by a hash of the
    text alone: half of each class, or all of a smaller class and the rest of the other; the same share of each
    class, the smaller hashes, where these have more than ``most_places`` places together."""
    parts = 1 << 20
    want = {False: min(bad, max(rows // 2, rows - good)), True: min(good, max(rows // 2, rows - bad))}
    most = {False: min(parts, -(-want[False] * parts // bad)), True: min(parts, -(-want[True] * parts // good))}
    train = train.select(text_key(F.col("t")).alias("key"), "t", "good")
    place = F.pmod(F.col("key"), F.lit(parts))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t", AT_ONCE):
                found = [f.astype(np.int32) for f in features(part.column(2))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([f.tobytes() for f in found], pa.binary()),
                     pa.array([len(f) for f in found], pa.int64())], names=["key", "good", "f", "n"])

    while True:
        # the larger bound again by itself, so that it is applied before texts move to the labels
        some = train.where(place < max(most.values())).where(place < F.when(F.col("good"), most[True]).otherwise(
            most[False])).groupBy("key", "good").agg(F.min("t").alias("t"))
        some, at = stored(some.select("key", "good", "t").mapInArrow(each, "key long, good boolean, f binary, n long"), "fit-sample")
        count = {r.good: (r.rows, r.n) for r in some.groupBy("good").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n")).collect()}
        # rows repeated very often leave few different texts
        few = [g for g in most if most[g] < parts and count.get(g, (0, 0))[0] < want[g] / 2]
        if not few:
            break
        drop_stored(train.sparkSession, at)
        most.update({g: min(parts, 4 * most[g]) for g in few})
    total = sum(n for _, n in count.values())
    if total > most_places:
        share = {g: int(n * most_places / total) for g, (_, n) in count.items()}
        order = Window.partitionBy("good").orderBy(place, "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        some = some.withColumn("so_far", F.sum("n").over(order)).where(  # the first text of a class in any case
            (F.col("so_far") <= F.when(F.col("good"), share.get(True, 0)).otherwise(share.get(False, 0))) | (F.col("so_far") == F.col("n")))
    got = some.select("key", "good", "f").toArrow()
    packed, label = got.column("f").to_pylist(), got.column("good").to_pylist()
    drop_stored(train.sparkSession, at)
    order = np.lexsort((np.array(label, bool), got.column("key").to_numpy())) if got.num_rows else []
    return [np.frombuffer(packed[i], np.int32) for i in order], np.array([1 if label[i] else -1 for i in order])


def descend(found: list[np.ndarray], label: np.ndarray, ratio: np.ndarray, epochs: int = EPOCHS,
            cost: float = COST) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss: each step solves one document's multiplier exactly
    within [0, its cost] and moves the weights by the change."""
    weight, bias = np.zeros(len(ratio)), 0.0
    values = [ratio[f] for f in found]
    values = [v / ((v * v).sum() ** 0.5 or 1.0) for v in values]
    top = {s: cost * len(label) / (2 * max((label == s).sum(), 1)) for s in (-1, 1)}
    alpha, rng = np.zeros(len(label)), np.random.default_rng(SEED)
    for _ in range(epochs):
        for k in rng.permutation(len(label)):
            f, v, s = found[k], values[k], label[k]
            slope = s * (weight[f] @ v + bias) - 1
            new = min(max(alpha[k] - slope / 2, 0.0), top[s])  # 2: length one and the bias
            if new != alpha[k]:
                step = (new - alpha[k]) * s
                weight[f] += step * v
                bias += step
                alpha[k] = new
    return weight, bias


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Model learned from the documents that have a label (callers leave held-out rows out)."""
    train = labelled(docs, labels)
    ratio, bad, good = ratios(train)
    if not bad or not good:
        return Model(np.zeros(PLACES), np.zeros(PLACES), float(good > 0) - float(bad > 0))
    weight, bias = descend(*sample(train, rows, bad, good), ratio)
    return Model(ratio * weight, ratio * ratio, bias)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with all its columns, then _score; only the text goes to Python."""
    refuse(docs, "_score")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^17 places, whatever the input

    def each(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held("quality", dict)
        own = shared.value
        for texts in arrays:
            batch = pa.RecordBatch.from_arrays([texts], names=["t"])
            yield pa.array([logistic(own.margin(f)) for part in slices(batch, "t", AT_ONCE) for f in features(part.column(0))], pa.float64())

    return docs.withColumn("_score", F.arrow_udf(each, "double")(F.col(text)))


def held_out(doc_id):
    return crc_mod(doc_id, 3) == 1


def op3(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Row per document: doc_id, held_out, score, predicted; learned from rows that are not held out."""
    model = fit(docs.where(~held_out(F.col("doc_id"))), labels)
    out = score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"),
                      (F.col("_score") >= 0.5).cast("int").alias("predicted"))
