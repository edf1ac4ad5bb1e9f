"""Language identification by cross-parsing entropy.

Per language a suffix automaton recognises every substring of its sample text.  A document is parsed
against each language: the longest match with the sample is a phrase, the next phrase starts behind
it, and a symbol the sample lacks is a phrase of its own.  A phrase costs log2 of the sample's length;
the language with the least cost per symbol wins (ties: the smaller name).

Symbols are the UTF-8 bytes of the lower-cased text with every run of ASCII non-letters made one space.
Texts are parsed whole, in blocks of ``BLOCK`` symbols that start a phrase of their own, so that many
blocks step through the automata together and a very long text does not lengthen the walk.

Samples: the different texts of a language (copies count once) of at most ``LONGEST`` characters, by
ascending hash, whole texts until ``SAMPLE_SYMBOLS`` symbols are held (documented bounds of what the
driver learns from).  About ``SAMPLE_DOCS`` texts, or as many as have twice these symbols, are fetched
at first, and four times as many while a language with more texts is short.  One still short of symbols
adds its shortest longer text.
Null languages teach nothing.  Null texts and texts without a letter are ``und`` with score 0, as is
everything when no language was learned.  The score is second / (first + second) cost, 1 when one
language is known.  Rows are independent; ids may repeat or be null.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, text_key, text_map

BLOCK = 2048
SAMPLE_DOCS, LONGEST, SAMPLE_SYMBOLS = 100, 20_000, 40_000
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
#: Byte of a lower-cased text -> symbol; ASCII other than letters is the space.
SYMBOL = np.arange(256, dtype=np.uint8)
SYMBOL[[b for b in range(128) if not chr(b).isalpha()]] = 32


def symbols(text: str) -> np.ndarray:
    raw = SYMBOL[np.frombuffer((" " + text.lower() + " ").encode(), np.uint8)]
    space = raw == 32
    return raw[~(space & np.r_[False, space[:-1]])]


def automaton(texts: list[bytes]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of several texts; no match reaches from one into another."""
    after: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    for text in texts:
        last = 0
        for symbol in text:
            known = after[last].get(symbol)
            if known is not None:  # the same words occurred in an earlier text
                last = known if length[known] == length[last] + 1 else _split(after, link, length, last, symbol, known)
                continue
            state = len(after)
            after.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and symbol not in after[at]:
                after[at][symbol] = state
                at = link[at]
            if at >= 0:
                to = after[at][symbol]
                link[state] = to if length[to] == length[at] + 1 else _split(after, link, length, at, symbol, to)
            last = state
    return after


def _split(after, link, length, at: int, symbol: int, to: int) -> int:
    """The part of state ``to`` that is reached from ``at`` becomes a state of its own."""
    twin = len(after)
    after.append(dict(after[to]))
    length.append(length[at] + 1)
    link.append(link[to])
    link[to] = twin
    while at >= 0 and after[at].get(symbol) == to:
        after[at][symbol] = twin
        at = link[at]
    return twin


@dataclass
class Model:
    """All automata in flat arrays.  A state is a few words of 64 bits, one bit per class of symbols that leads
    on; the states reached stand in the order of these bits, so a transition is found by counting bits."""

    names: list[str]
    phrase_cost: np.ndarray
    classes: np.ndarray  # language, symbol -> class; class 0 is in no sample
    root: np.ndarray  # first place of each language
    first: np.ndarray  # language, class -> place from the root (the root where there is none)
    mask: np.ndarray  # place + class // 64 -> classes that lead on
    edge: np.ndarray  # the same -> their first entry in ``to``
    to: np.ndarray  # places reached

    @classmethod
    def learn(cls, samples: dict[str, list[np.ndarray]]) -> "Model":
        names = sorted(samples)
        classes = np.zeros((len(names), 256), np.uint8)
        root, first = np.zeros(len(names), np.int64), np.zeros((len(names), 257), np.int32)
        masks, edges, reached, base, count = [np.zeros(1, np.uint64)], [np.zeros(1, np.int32)], [], 1, 0
        for k, name in enumerate(names):
            seen = np.unique(np.concatenate(samples[name]))
            classes[k, seen] = np.arange(1, len(seen) + 1)
            words = len(seen) // 64 + 1
            after = automaton([classes[k][x].tolist() for x in samples[name]])
            state = np.repeat(np.arange(len(after)), [len(x) for x in after])
            symbol = np.array([c for x in after for c in x], np.int64)
            to = np.array([t for x in after for t in x.values()], np.int64)
            order = np.lexsort((symbol, state))
            state, symbol, to = state[order], symbol[order], (base + to[order] * words).astype(np.int32)
            word = state * words + (symbol >> 6)
            mask = np.zeros(len(after) * words, np.uint64)
            np.bitwise_or.at(mask, word, np.uint64(1) << (symbol & 63).astype(np.uint64))
            masks.append(mask)
            edges.append((count + np.searchsorted(word, np.arange(len(mask)))).astype(np.int32))
            reached.append(to)
            root[k], first[k] = base, base
            first[k, symbol[state == 0]] = to[state == 0]
            base, count = base + len(mask), count + len(to)
        cost = np.array([np.log2(1 + sum(map(len, samples[n]))) for n in names])
        return cls(names, cost, classes, root, first, np.concatenate(masks), np.concatenate(edges),
                   np.concatenate([*reached, np.zeros(1, np.int32)]))

    def size(self) -> int:
        """Bytes held."""
        return sum(x.nbytes for x in (self.classes, self.first, self.mask, self.edge, self.to))

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (rows) in each language (columns)."""
        out = np.zeros((len(texts), len(self.names)), np.int64)
        sizes = np.array([len(t) for t in texts])
        if not len(self.names) or not sizes.sum():
            return out
        flat = np.concatenate(texts)
        blocks = -(-sizes // BLOCK)
        row = np.repeat(np.arange(len(texts)), blocks)
        number = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = np.repeat(np.cumsum(sizes) - sizes, blocks) + number * BLOCK
        size = np.minimum(sizes[row] - number * BLOCK, BLOCK)
        order = np.argsort(-size, kind="stable")
        row, start, size = row[order], start[order], size[order]
        active = np.searchsorted(-size, -np.arange(size[0]), side="left")  # blocks longer than each step
        for k, root in enumerate(self.root):
            classes, first, unknown = self.classes[k], self.first[k], self.first[k] == root
            place, ended = np.full(len(row), root, np.int32), np.zeros(len(row), np.int32)
            for step in range(int(size[0])):
                n = active[step]
                c = classes[flat[start[:n] + step]]
                here = place[:n]
                word = here + (c >> 6)
                mask, bit = self.mask[word], np.uint64(1) << (c & 63).astype(np.uint64)
                on = (mask & bit) != 0
                ahead = self.to[self.edge[word] + np.bitwise_count(mask & (bit - np.uint64(1)))]
                # no transition: a phrase ends and the next one starts; a symbol the sample lacks is one
                ended[:n] += ~on & (here != root)
                ended[:n] += ~on & unknown[c]
                place[:n] = np.where(on, ahead, first[c])
            ended += place != root  # the phrase that the block's end cuts
            np.add.at(out[:, k], row, ended)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        cut = [symbols(t) if LETTER.search(t) else np.zeros(0, np.uint8) for t in texts]
        if not self.names:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        cost = self.phrases(cut) * self.phrase_cost
        best = cost.argmin(1)
        two = np.sort(cost, 1)[:, :2]
        score = two[:, 1] / np.maximum(two.sum(1), 1e-9) if len(self.names) > 1 else np.ones(len(texts))
        return ([self.names[b] if len(c) else UNKNOWN for b, c in zip(best, cut)],
                [float(s) if len(c) else 0.0 for s, c in zip(score, cut)])


def samples(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, list[np.ndarray]]:
    """Sample texts of each language as symbols."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(lang).alias("lang"), F.col(text).alias("t"), text_key(F.col(text)).alias("h"))
    fits, size = F.length("t") <= LONGEST, F.col("size")
    texts = rows.groupBy("lang", "h").agg(F.min(F.length("t")).alias("size"))  # copies count once
    known = {r["lang"]: r for r in texts.groupBy("lang").agg(
        F.count(F.when(size <= LONGEST, 1)).alias("n"), F.avg(F.when(size <= LONGEST, size)).alias("mean"),
        F.min(F.when(size > LONGEST, size)).alias("longer")).collect()}  # a row per language
    out: dict[str, list[np.ndarray]] = {l: [] for l in known}
    short = lambda l: sum(map(len, out[l])) < SAMPLE_SYMBOLS
    parts = 1 << 30
    most = {l: min(parts, math.ceil(max(SAMPLE_DOCS, 2 * SAMPLE_SYMBOLS / r.mean) * parts / r.n)) for l, r in known.items() if r.n}
    while most:
        share = F.create_map(*[F.lit(x) for pair in most.items() for x in pair])
        chosen = rows.where(fits & (F.pmod("h", F.lit(parts)) < F.coalesce(share[F.col("lang")], F.lit(0))))
        out.update({l: [] for l in most})
        for r in sorted(chosen.groupBy("lang", "h").agg(F.min("t").alias("t")).collect(), key=lambda r: (r.h % parts, r.h)):
            if short(r["lang"]):
                out[r["lang"]].append(symbols(r.t))
        most = {l: min(parts, 4 * m) for l, m in most.items() if m < parts and short(l)}
    longer = {l: r.longer for l, r in known.items() if r.longer and short(l)}
    if longer:
        size = F.create_map(*[F.lit(x) for pair in longer.items() for x in pair])[F.col("lang")]
        for r in rows.where(F.length("t") == size).groupBy("lang").agg(F.min(F.struct("h", "t")).alias("x")).collect():
            out[r["lang"]].append(symbols(r.x.t))
    return out


def identify(docs: DataFrame, model: Model, text: str = "text", carry=None) -> DataFrame:
    """Carried columns (default all), then _lang and _lang_score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the samples
    return text_map(docs, text, {"_lang": "string", "_lang_score": "double"}, lambda: shared.value.predict, carry, 4 << 20)


def held_out(doc_id):
    return crc_mod(doc_id, 4) == 2


def op7(docs: DataFrame) -> DataFrame:
    """Row per document: doc_id, held_out, lang_pred, score; learned from rows that are not held out."""
    model = Model.learn(samples(docs.where(~held_out(F.col("doc_id")))))
    out = identify(docs.select("doc_id", "text"), model, carry=["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_lang").alias("lang_pred"),
                      F.col("_lang_score").alias("score"))
