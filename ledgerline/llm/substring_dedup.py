"""Substring dedup by hashing sentences of lines.

Words are ``[^\\x20\\x09-\\x0D]+``, A-Z in lower case.  A unit is a run of words of one line: it ends with its
line, after a word that ends in one of ``.!?``, or after a word of ``LONG_WORD`` characters or more (a place
that follows from the content, so that sentences without an end are cut alike in all copies).  A document
of fewer than ``MIN_WORDS`` words and ``MIN_BYTES`` bytes in words is one unit, equal only to such
documents.  Units are normalised (lower case, one space between words) and hashed to 128 bits.

Units are ranked by (doc_id, text key, unit number), null ids first; of equal units the first in rank
stays, the others are repeats.  Runs of consecutive repeats go where they have ``MIN_WORDS`` words or
``MIN_BYTES`` bytes together: shorter ones are chance repeats and stock lines, not passages.  A one-unit
document that repeats goes whole.  A removed unit goes with the white space behind it; what is left is the
original text, and removed units carry their original character offsets.

Blank lines and null, empty or blank texts have no units.  Rows repeated with the same id and text are one
document and are treated alike.  Input columns may have any names but those that a function adds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytehash
from .common import fresh, held, refuse, slices, stored, text_key, utf8

MIN_WORDS, MIN_BYTES, LONG_WORD = 25, 180, 14
AT_ONCE = 2 << 20
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, *range(9, 14)]] = False
LOWER = np.arange(256)
LOWER[65:91] += 32
ENDS = np.zeros(256, bool)
ENDS[list(b".!?")] = True
#: A second random value per byte, for the other half of the hash; and what tells one-unit documents apart.
OTHER = np.random.default_rng(20241).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
WHOLE = np.uint64(0x5851F42D4C957F2D)
UNIT = "struct<unit:int,start:int,stop:int,first_doc_id:bigint,first_unit:int>"
CUT = f"struct<text:string,removed:array<{UNIT}>>"


class Units:
    """Units of many texts: first word and the word behind the last, rows' first units, and sizes."""

    def __init__(self, column: pa.Array):
        raw, rows = utf8(column)
        self.raw, self.rows = raw, rows
        self.starts, self.stops, at = bytehash.words(raw, rows, NOT_SPACE)
        n = len(self.starts)
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        lines = np.concatenate([[0], np.cumsum(raw == 10)])
        size = np.concatenate([[0], np.cumsum(self.stops - self.starts)])
        last = np.zeros(n, bool)
        last[at[1:][at[1:] > at[:-1]] - 1] = True
        cut = last | ENDS[raw[self.stops - 1]] | (chars[self.stops] - chars[self.starts] >= LONG_WORD)
        cut[:-1] |= lines[self.starts[1:]] > lines[self.stops[:-1]]
        small = (np.diff(at) < MIN_WORDS) & (size[at[1:]] - size[at[:-1]] < MIN_BYTES)
        cut &= last | ~small[row]
        self.stop = np.flatnonzero(cut) + 1  # words
        self.start = np.concatenate([[0], self.stop[:-1]]).astype(np.int64)[:len(self.stop)]
        self.row = row[self.start]
        self.small = small[self.row]
        self.at = np.searchsorted(self.row, np.arange(len(at)))
        self.number = np.arange(len(self.row)) - self.at[self.row]
        self.words = self.stop - self.start
        self.bytes = size[self.stop] - size[self.start]
        self.chars = chars

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of every unit's words."""
        out = []
        for value in (bytehash.VALUE, OTHER):
            word = bytehash.mix(bytehash.PrefixHash(self.raw, value[LOWER]).of(self.starts, self.stops))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(word * bytehash.powers(len(word)))])
            unit = (sums[self.stop] - sums[self.start]) * bytehash.inverse_powers(len(sums))[self.start]
            out.append(bytehash.mix(unit + WHOLE * self.small))
        return out[0], out[1]

    def spans(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """Bytes where the row's units begin, and where the next unit begins (or the text ends)."""
        own = slice(self.at[row], self.at[row + 1])
        begin = self.starts[self.start[own]]
        return begin, np.concatenate([begin[1:], [self.rows[row + 1]]])


def units(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per unit: id, tk, unit, d1, d2."""
    rows = docs.select(F.col(key).cast("long").alias("id"), text_key(F.col(text)).alias("tk"), F.col(text).alias("t"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("substring", dict)
        for batch in batches:
            for part in slices(batch, "t", AT_ONCE):
                found = Units(part.column(2))
                d1, d2 = found.digests()
                row = pa.array(found.row)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(row), part.column(1).take(row), pa.array(found.number.astype(np.int32)),
                     pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64))], names=["id", "tk", "unit", "d1", "d2"])

    return rows.mapInArrow(each, "id long, tk long, unit int, d1 long, d2 long")


def repeated_units(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document with repeats: id, tk, gone (unit, first_doc_id, first_unit of each, in order)."""
    found = units(docs, key, text)
    place = F.struct("id", "tk", "unit")
    first = (found.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("d1", "d2", "first"))
    first, _ = stored(first, "first-units")  # joined from a table, so a unit held by many documents can be split
    gone = found.join(first.hint("merge"), ["d1", "d2"]).where(~place.eqNullSafe(F.col("first")))
    unit = F.struct("unit", F.col("first.id").alias("first_doc_id"), F.col("first.unit").alias("first_unit"))
    return gone.groupBy("id", "tk").agg(F.sort_array(F.collect_set(unit)).alias("gone"))


def passages(gone: list[int], words: np.ndarray, size: np.ndarray, small: bool) -> list[int]:
    """Those of the repeated units (numbers, ascending) that stand in runs long enough to go."""
    out, run = [], []

    def close() -> None:
        if small or sum(words[run]) >= MIN_WORDS or sum(size[run]) >= MIN_BYTES:
            out.extend(run)

    for number in gone:
        if run and number != run[-1] + 1:
            close()
            run = []
        run.append(number)
    close()
    return out


def cut_texts(texts: pa.Array, gone: pa.Array) -> pa.Array:
    """(text, removed) of the texts whose repeats are given; null where there are none."""
    found, out = Units(texts), []
    for row, repeats in enumerate(gone.to_pylist()):
        own = slice(found.at[row], found.at[row + 1])
        first = {r["unit"]: r for r in repeats or ()}
        removed = passages(sorted(first), found.words[own], found.bytes[own], bool(found.small[own][:1].any())) if first else []
        if not removed:
            out.append(None)
            continue
        begin, end = found.spans(row)
        base, kept, at = found.rows[row], [], found.rows[row]
        for number in removed:
            kept.append(found.raw[at:begin[number]])
            at = end[number]
        kept.append(found.raw[at:found.rows[row + 1]])
        place = lambda b: int(found.chars[b] - found.chars[base])  # noqa: B023, E731
        out.append({"text": np.concatenate(kept).tobytes().decode(),
                    "removed": [first[n] | {"start": place(begin[n]), "stop": place(end[n])} for n in removed]})
    unit = pa.struct([("unit", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("first_doc_id", pa.int64()), ("first_unit", pa.int32())])
    return pa.array(out, pa.struct([("text", pa.string()), ("removed", pa.list_(unit))]))


def cut_all(pairs: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    held("substring", dict)
    for texts, gone in pairs:
        batch = pa.RecordBatch.from_arrays([texts, gone], names=["t", "g"])
        parts = [cut_texts(p.column(0), p.column(1)) for p in slices(batch, "t", AT_ONCE)]
        yield pa.concat_arrays(parts) if parts else cut_texts(texts, gone)


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` with all its columns, then _removed (units) and _kept_text."""
    refuse(docs, "_removed", "_kept_text")
    tk, own_id, own_tk, gone, out = fresh(docs, "tk", "id2", "tk2", "gone", "cut")
    repeats = repeated_units(docs, key, text).select(F.col("id").alias(own_id), F.col("tk").alias(own_tk), F.col("gone").alias(gone))
    joined = docs.withColumn(tk, text_key(F.col(text)))
    joined = joined.join(repeats.hint("merge"), F.col(key).cast("long").eqNullSafe(F.col(own_id)) & (F.col(tk) == F.col(own_tk)), "left")
    # only texts with repeats go to Python
    cut = F.arrow_udf(cut_all, CUT)(F.when(F.col(gone).isNotNull(), F.col(text)), F.col(gone))
    whole = joined.withColumn(out, cut)
    return (whole.withColumn("_removed", F.coalesce(F.col(f"{out}.removed"), F.array().cast(f"array<{UNIT}>")))
            .withColumn("_kept_text", F.when(F.col(out).isNull(), F.col(text)).otherwise(F.col(f"{out}.text")))
            .drop(tk, own_id, own_tk, gone, out))


def op1(docs: DataFrame) -> DataFrame:
    """Row per document: doc_id, n_removed units, removed_chars, first_doc_id (smallest document that
    keeps a unit removed here, -1 if none), removed (character spans ``start-stop``, comma-joined), text (kept)."""
    out = dedup(docs.select("doc_id", "text"))
    chars = F.aggregate("_removed", F.lit(0).cast("long"), lambda a, r: a + (r["stop"] - r["start"]).cast("long"))
    spans = F.transform("_removed", lambda r: F.concat_ws("-", r["start"].cast("string"), r["stop"].cast("string")))
    return out.select("doc_id", F.size("_removed").cast("long").alias("n_removed"), chars.alias("removed_chars"),
                      F.coalesce(F.array_min(F.transform("_removed", lambda r: r["first_doc_id"])), F.lit(-1)).alias("first_doc_id"),
                      F.array_join(spans, ",").alias("removed"), F.col("_kept_text").alias("text"))


ORACLE = r"""
WITH p AS (SELECT doc_id, generate_subscripts(x, 1) AS i, unnest(x) AS piece
      FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS x FROM documents WHERE text <> '')),
q AS (SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
        lead(piece) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM p),
w AS (SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) IS NULL AS last,
        count(*) OVER (PARTITION BY doc_id) < 25 AND sum(strlen(piece)) OVER (PARTITION BY doc_id) < 180 AS small
      FROM q WHERE regexp_full_match(piece, '[^\x20\x09-\x0D]+')),
c AS (SELECT *, last OR (NOT small AND (right(piece, 1) IN ('.', '!', '?') OR length(piece) >= 14 OR contains(gap, chr(10)))) AS cut FROM w),
n AS (SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS unit FROM c),
u AS (SELECT doc_id, unit, small, min(start) AS start, count(*) AS words, sum(strlen(piece)) AS bytes,
        string_agg(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' ORDER BY i) AS norm FROM n GROUP BY ALL),
f AS (SELECT u.*, lead(start) OVER (PARTITION BY doc_id ORDER BY unit) AS after, row_number() OVER k AS r, first(doc_id) OVER k AS first_doc
      FROM u WINDOW k AS (PARTITION BY small, norm ORDER BY doc_id, unit)),
g AS (SELECT *, unit - row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS island FROM f WHERE r > 1),
h AS (SELECT doc_id, unit, first_doc FROM g
      QUALIFY small OR sum(words) OVER (PARTITION BY doc_id, island) >= 25 OR sum(bytes) OVER (PARTITION BY doc_id, island) >= 180),
e AS (SELECT f.doc_id, f.unit, f.start, coalesce(f.after, length(d.text)) AS stop, d.text, h.unit IS NOT NULL AS gone, h.first_doc
      FROM f JOIN documents d ON f.doc_id = d.doc_id LEFT JOIN h ON f.doc_id = h.doc_id AND f.unit = h.unit),
s AS (SELECT doc_id, sum(gone::INT)::BIGINT AS n_removed, coalesce(sum(stop - start) FILTER (gone), 0)::BIGINT AS removed_chars,
        coalesce(min(first_doc), -1) AS first_doc_id,
        coalesce(string_agg(start::BIGINT || '-' || stop::BIGINT, ',' ORDER BY unit) FILTER (gone), '') AS removed,
        first(text)[1:min(start)::BIGINT] || coalesce(string_agg(text[start::BIGINT + 1:stop::BIGINT], '' ORDER BY unit) FILTER (NOT gone), '') AS text
      FROM e GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_removed, 0) AS n_removed, coalesce(removed_chars, 0) AS removed_chars, coalesce(first_doc_id, -1) AS first_doc_id,
       coalesce(removed, '') AS removed, CASE WHEN s.doc_id IS NULL THEN d.text ELSE s.text END AS text
FROM documents d LEFT JOIN s ON d.doc_id = s.doc_id
"""
