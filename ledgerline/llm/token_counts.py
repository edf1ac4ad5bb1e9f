"""Token counts of a word-level byte-pair vocabulary by rank-synchronous array merging.

Special strings of the vocabulary are found in the raw text first and count as one token each.  What
lies between is made NFC, white space and case are folded, and the vocabulary file's own pattern
cuts it into pre-tokens.  None of this reaches over white space, so a text is first cut there.  The
pre-tokens of a batch's distinct words become ragged arrays of byte symbols, the last
one with the end-of-word mark; all are merged at once and the surviving symbols counted.  A worker
remembers the counts of short words, up to ``REMEMBER`` of them.

Null texts are empty: zero bytes, zero tokens.  Every row is counted by itself, whatever its id; the
vocabulary file's place is a parameter and must exist on every executor.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memory, held, text_map
from .merge_rounds import PairTable, merge

LIMIT = 2048
REMEMBER = 300_000
#: White space of the pattern's \\s; Python's own splitting also cuts at the four separators 1C to 1F.
SPACE, CONTROL = regex.compile(r"\s+"), regex.compile(r"[\x1c-\x1f]")
#: Lower case of letters that this Python's tables lack, and of the one whose lower case it varies.
LOWER_FIRST = {0x03A3: 0x03C3, 0xA7CB: 0x0264, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DC: 0x019B}

#: Letters and numbers that Unicode has had since version 17 or later and that the vocabulary's
#: library (version 16) takes for neither.
NEWER = """
    0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959
    10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3
    16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6
    1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4
    1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""

#: Marks that the library's normal form (Unicode 9) takes for letters that nothing joins or passes.
STARTERS = """
    07FD 0898-089F 08CA-08D3 09FE 0C3C 0D3B-0D3C 0EBA 1715 1ABF-1ACE 1DF6-1DFA A82C 10D24-10D27 10EAB-10EAC
    10EFD-10EFF 10F46-10F50 10F82-10F85 11070 1133B 1145E 11839-1183A 11930 1193D-1193E 11943 119E0 11A34 11A47 11A99
    11D42 11D44-11D45 11D97 11F41-11F42 16FF0-16FF1 1E08F 1E130-1E136 1E2AE 1E2EC-1E2EF 1E4EC-1E4EF
"""


def _listed(ranges: str) -> str:
    """The inside of a character class."""
    return "".join("-".join(f"\\U{int(end, 16):08x}" for end in ends.split("-")) for ends in ranges.split())


SEPARATE = regex.compile(f"([{_listed(STARTERS)}])")


def composed(text: str) -> str:
    """Normal form C as the library makes it."""
    if not SEPARATE.search(text):
        return unicodedata.normalize("NFC", text)
    return "".join(unicodedata.normalize("NFC", part) for part in SEPARATE.split(text))


def library_classes(pattern: str) -> str:
    """The pattern with ``\\p{L}`` and ``\\p{N}`` as the library knows them."""
    for kind in ("L", "N"):
        pattern = pattern.replace(f"\\p{{{kind}}}", f"[\\p{{{kind}}}--[{_listed(NEWER)}]]")
    return pattern


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in such vocabularies: printable ones stand for
    themselves, the others for the letters from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, ids = spec["model"], spec["model"]["vocab"]
        end = model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([ids[letters[b]] for b in range(256)])
        self.last = np.array([ids[letters[b] + end] for b in range(256)])
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.pairs = PairTable([ids[a] for a, _ in pairs], [ids[b] for _, b in pairs],
                               [ids[a + b] for a, b in pairs], range(len(pairs)))
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(library_classes(split["pattern"]["Regex"]), regex.V1)
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.known = Memory(REMEMBER)

    def pretokens(self, word: str) -> tuple[list[str], int]:
        """Pre-tokens of a word (the commonest forms without the pattern), and how many special strings it has."""
        if word.isascii():
            if word.isalpha():
                return [word.lower()], 0
            if word[:-1].isalpha() and word[-1] in ".,":
                return [word[:-1].lower(), word[-1]], 0
        found, parts = 0, [word]
        if self.special is not None and "<|" in word:
            parts = self.special.split(word)
            found = len(parts) - 1
        out: list[str] = []
        for part in parts:
            if not part.isascii():
                part = composed(part).translate(LOWER_FIRST)
            out += self.pattern.findall(part.lower())
        return out, found

    def count(self, words: list[str]) -> list[int]:
        """Tokens of each word: its special strings and the symbols left of its pre-tokens."""
        cut = [self.pretokens(w) for w in words]
        raw = [p.encode() for parts, _ in cut for p in parts]
        total = np.array([n for _, n in cut])
        if raw:
            lengths = np.array([len(p) for p in raw])
            flat = np.frombuffer(b"".join(raw), np.uint8)
            symbols = self.inner[flat]
            stops = np.cumsum(lengths) - 1
            symbols[stops] = self.last[flat[stops]]
            left = merge(symbols, lengths, self.pairs)[1]
            owner = np.repeat(np.arange(len(words)), [len(parts) for parts, _ in cut])
            total += np.bincount(owner, left, len(words)).astype(np.int64)
        return total.tolist()

    def totals(self, texts: list[str]) -> list[int]:
        cut = []
        for t in texts:
            if t.isascii() and "<|" not in t:  # case can be folded before words are told apart
                t = t.lower()
            cut.append(SPACE.split(t) if CONTROL.search(t) else t.split())
        counts = self.known.fill(set().union(*cut), self.count)
        return [sum(map(counts.__getitem__, w)) for w in cut]


def vocabulary(path: str) -> Vocabulary:
    return held(f"_n_tokens {path}", lambda: Vocabulary(path))


def token_counts(docs: DataFrame, path: str, text: str = "text", carry=None) -> DataFrame:
    """Carried columns (default all), then _n_tokens."""
    return text_map(docs, text, {"_n_tokens": "long"}, lambda: lambda texts: [vocabulary(path).totals(texts)], carry)


def op2(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Row per document: doc_id, n_bytes, n_tokens, over_limit."""
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes")
    out = token_counts(docs.select("doc_id", n_bytes, "text"), path, carry=["doc_id", "n_bytes"])
    return out.select("doc_id", "n_bytes", F.col("_n_tokens").alias("n_tokens"), (F.col("_n_tokens") > limit).alias("over_limit"))
