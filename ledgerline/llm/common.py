"""Helpers shared by the operators: session settings, row keys, text columns, scratch tables."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import configure, delete_path, scratch_path

from . import bytehash

#: Rows of one Arrow batch sent to a Python worker, and the bytes the workers handle at once.
ROWS_PER_BATCH = 2000
BYTES_AT_ONCE = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators; Arrow batches are bounded by rows and by bytes."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_AT_ONCE))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: Column) -> Column:
    """Second half of a row's identity next to its id: repeated ids with other texts stay apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written in decimal, modulo ``mod`` (null id: the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def stored(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Write a table to the shared folder and read it again: lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.parquet(path), path


def drop_stored(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        delete_path(spark, path)


_HELD: dict = {}


def held(name: str, make: Callable[[], object]) -> object:
    """What a worker keeps between the tasks of one operator.  Workers outlive a stage, so what another
    operator kept goes first, and its memory back to the system."""
    if name not in _HELD:
        if _HELD:
            _HELD.clear()
            bytehash.forget()
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):
                pass  # another C library: it keeps freed memory for later use
        _HELD[name] = make()
    return _HELD[name]


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column of ``df`` has (whatever the case)."""
    there, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in there:
            name = f"_{name}"
        there.add(name.lower())
        out.append(name)
    return out


def refuse(df: DataFrame, *made: str) -> None:
    """Raise where the input has a column that a function adds."""
    clash = sorted({c for c in df.columns if c.lower() in {m.lower() for m in made}})
    if clash:
        raise ValueError(f"the input already has the column(s) that this adds: {', '.join(clash)}; rename or drop them")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string column (null: empty); no copy of the bytes."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0]:ends[-1]], ends - ends[0]


def slices(batch: pa.RecordBatch, text: str, most: int = BYTES_AT_ONCE):
    """Cut a batch into row ranges of about ``most`` text bytes (one row at least)."""
    column = batch.column(batch.schema.get_field_index(text))
    _, ends = utf8(column)
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(ends, ends[start] + most, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


ARROW = {"long": (T.LongType(), pa.int64()), "int": (T.IntegerType(), pa.int32()), "double": (T.DoubleType(), pa.float64()),
         "string": (T.StringType(), pa.string()), "boolean": (T.BooleanType(), pa.bool_()),
         "ints": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))}


def in_parts(texts: list[str], most: int) -> Iterator[list[str]]:
    """Runs of texts of about ``most`` characters together (one text at least)."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def text_map(docs: DataFrame, text: str, made: dict[str, str], setup: Callable[[], Callable[[list[str]], Sequence]],
             carry: Sequence[str] | None = None, most: int = 2 << 20) -> DataFrame:
    """Carried columns (default all) and new ones computed from the texts (null: empty) in a worker.

    ``setup`` runs once per task and gives a function from texts to one sequence per new column."""
    carry = list(docs.columns if carry is None else carry)
    refuse(docs.select(*[f"`{c}`" for c in carry]), *made)
    schema = T.StructType([docs.schema[c] for c in carry])
    for column, kind in made.items():
        schema = schema.add(column, ARROW[kind][0])
    kinds = [ARROW[kind][1] for kind in made.values()]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = setup()
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            parts = [fn(part) for part in in_parts(texts, most)]
            new = [pa.array([v for part in parts for v in part[n]], kind) for n, kind in enumerate(kinds)]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in carry]
            yield pa.RecordBatch.from_arrays([*kept, *new], names=[*carry, *made])

    return docs.select(*dict.fromkeys([*carry, text])).mapInArrow(each, schema)


class Memory:
    """Values computed for short keys; two generations of at most ``most`` / 2 keys, so that keys in
    use stay.  ``fill`` makes the values of a batch's keys available in the dictionary it returns."""

    def __init__(self, most: int, short: int = 40):
        self.half, self.short, self.now, self.old = most // 2, short, {}, {}

    def fill(self, keys: set, make: Callable[[list], Sequence]) -> dict:
        old, missing = self.old, keys.difference(self.now)
        if missing:
            self.now.update([(k, old[k]) for k in missing if k in old])
            new = list(missing.difference(old))
            if new:
                self.now.update(zip(new, make(new)))
        out = self.now
        if len(out) > self.half:
            self.old, self.now = {k: v for k, v in out.items() if len(k) <= self.short} if len(out) <= 2 * self.half else {}, {}
        elif missing and any(len(k) > self.short for k in missing):
            self.now = {k: v for k, v in out.items() if len(k) <= self.short}
        return out
