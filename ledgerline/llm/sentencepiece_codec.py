"""SentencePiece byte-pair encoding and decoding by vectorised merge rounds.

The model file is read for its pieces and scores only; no library encodes.  A text gets a leading space
mark and its spaces become marks.  No piece holds a mark after another character, nor a line break, so
a text is cut there into words without changing the result.  A batch's distinct words become flat
arrays of character symbols; each round finds every word's best-scored pair by a segmented minimum,
merges its leftmost occurrences at once and compacts, until no pair remains.  Characters outside the
vocabulary become their byte pieces.  Decoding joins the pieces of the ids, reads byte pieces as UTF-8
(bytes that are none become U+FFFD) and takes the leading mark off.

Null texts are empty: no ids, empty decoded text.  Rows are independent.  The model's place is a
parameter and must exist on every executor.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memory, held, text_map
from .merge_rounds import PairTable, merge

MARK = "▁"
REMEMBER = 500_000
SEGMENT = re.compile(r"\n[^ \n]*| *[^ \n]+| +").findall


class Codec:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.decimal = [str(i) for i in range(size)]
        self.spoken = [p.replace(MARK, " ") for p in self.pieces]
        self.byte = np.full(256, -1)
        self.byte_of: dict[int, int] = {}
        normal: dict[str, int] = {}
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.byte_of[i] = int(piece[3:5], 16)
            elif not (model.is_control(i) or model.is_unknown(i)):
                normal[piece] = i
        if any(MARK in p.lstrip(MARK) for p in normal):
            raise ValueError("a piece holds a space mark after another character")
        order = sorted(normal.values(), key=lambda i: (-model.get_score(i), i))
        rank = {i: n for n, i in enumerate(order)}
        found = [(normal[p[:k]], normal[p[k:]], i, rank[i]) for p, i in normal.items() for k in range(1, len(p))
                 if p[:k] in normal and p[k:] in normal]
        self.pairs = PairTable(*[[x[k] for x in found] for k in range(4)])
        self.letters = {p: i for p, i in normal.items() if len(p) == 1}
        if any("\n" in p for p in normal):
            raise ValueError("a piece holds a line break")
        self.known = Memory(REMEMBER)

    @staticmethod
    def words(text: str) -> list[str]:
        """Words of a text; a word stands for a space mark and its characters, except that a word
        beginning with a line break stands for its characters only."""
        text = text.replace(MARK, " ")
        if "  " not in text and not text.startswith(" "):
            return text.replace("\n", " \n").split(" ") if text else []
        return [w if w[0] == "\n" else w[1:] for w in SEGMENT(" " + text)]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word."""
        words = [w if w.startswith("\n") else MARK + w for w in words]
        flat = np.frombuffer("".join(words).replace(" ", MARK).encode("utf-32-le"), np.uint32).astype(np.int64)
        points, back = np.unique(flat, return_inverse=True)
        # a symbol outside the vocabulary is held as -1 - code point meanwhile
        ids = np.array([self.letters.get(chr(p), -1 - p) for p in points.tolist()], np.int64)
        symbols, lengths = merge(ids[back], np.array([len(w) for w in words]), self.pairs)
        if (symbols < 0).any():
            word = np.repeat(np.arange(len(words)), lengths)
            bytes_of = {s: self.byte[np.frombuffer(chr(-1 - s).encode(), np.uint8)].tolist() for s in set(symbols[symbols < 0].tolist())}
            parts = [bytes_of[s] if s < 0 else (s,) for s in symbols.tolist()]
            lengths = np.bincount(np.repeat(word, [len(p) for p in parts]), minlength=len(words))
            listed = [i for p in parts for i in p]
        else:
            listed = symbols.tolist()
        stops = np.cumsum(lengths).tolist()
        return [listed[a:b] for a, b in zip([0, *stops], stops)]

    def decode(self, ids: list[int]) -> str:
        """Text of ids, leading space not taken off."""
        if self.byte_of.keys().isdisjoint(ids):
            return "".join([self.spoken[i] for i in ids])
        out, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.spoken[i])
        return "".join([*out, raw.decode("utf-8", "replace")])

    def encode_all(self, texts: list[str]) -> tuple[list[int], list[str], list[str]]:
        """Of each text the number of ids, the ids in decimal joined by commas, and the decoded text."""
        cut = [self.words(t) for t in texts]
        known = self.known.fill(set().union(*cut), self._made)
        n, ids, said = [], [], []
        for words in cut:
            got = [known[w] for w in words]
            listed = ",".join([g[0] for g in got])
            ids.append(listed)
            n.append(listed.count(",") + 1 if listed else 0)
            said.append("".join([g[1] for g in got])[1:])
        return n, ids, said

    def _made(self, words: list[str]) -> list[tuple[str, str]]:
        """Ids in decimal and decoded text of each word."""
        return [(",".join([self.decimal[x] for x in i]), self.decode(i)) for i in self.encode_words(words)]


def codec(path: str) -> Codec:
    return held(f"_ids {path}", lambda: Codec(path))


def encode(docs: DataFrame, path: str, text: str = "text", carry=None, ids: bool = False, decoded: bool = False) -> DataFrame:
    """Carried columns (default all), then _n_tokens, _ids_sha256, _decoded_sha256; on request also
    _ids (the ids) and _decoded (the text decoded from them)."""
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    made = {"_n_tokens": "long", "_ids_sha256": "string", "_decoded_sha256": "string"}
    made |= {"_ids": "ints"} if ids else {}
    made |= {"_decoded": "string"} if decoded else {}

    def setup():
        own = codec(path)

        def columns(texts: list[str]):
            n, listed, said = own.encode_all(texts)
            out = [n, map(sha, listed), map(sha, said)]
            out += [[np.array(i.split(","), np.int32) if i else [] for i in listed]] if ids else []
            return [*out, said] if decoded else out
        return columns

    return text_map(docs, text, made, setup, carry)


def op6(docs: DataFrame, path: str) -> DataFrame:
    """Row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    out = encode(docs, path, carry=["doc_id"])
    return out.select("doc_id", F.col("_n_tokens").alias("n_tokens"), F.col("_ids_sha256").alias("ids_sha256"),
                      F.col("_decoded_sha256").alias("decoded_sha256"))
