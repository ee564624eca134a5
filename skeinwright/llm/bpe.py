"""BPE encoding and decoding from a public tokenizer file, without the tokenizer library.

A word is a doubly linked list of symbols with a priority queue of merges (rank, place); the least rank,
leftmost first, is taken, and entries that no longer describe two neighbours are skipped. Words repeat,
so their ids are kept in a bounded cache. Decoding joins the vocabulary strings of the ids, as such
files without a decoder do, with single spaces.

The patterns' classes and the lower-casing are this Python's and ``regex``'s, whose Unicode tables differ from
the tokenizer library's. A text with a character that they may see differently (``unlike``: found out once from
the library, over all code points) is normalised and split by the library; the merges are always ours.

Defined results: a null or empty text has no ids and decodes to the empty string. Strings of the file's
added tokens are matched in the raw text first. Lower-casing goes by character. Rows are independent:
ties, repeated rows and empty tables need nothing special, and only the named text column is read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from bisect import bisect_right
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, bound_batches

CACHE = 400_000
LONG = 64
#: White space in the tokenizer's patterns (a fixed value): the Unicode property, without U+001C to U+001F.
SPACE = r"\t-\r \x85\xa0  -     　"
#: What Python splits words at but the patterns don't (a fixed value).
ODD_SPACE = "\x1c\x1d\x1e\x1f"


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself where it is printable Latin-1, else from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


Ranges = tuple[tuple[int, int], ...]


@lru_cache(maxsize=1)
def unlike() -> Ranges:
    """Ranges of code points that Python's tables lack, or that the library classes or lower-cases otherwise."""
    from tokenizers import Regex, normalizers, pre_tokenizers

    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    split = lambda pattern, how: pre_tokenizers.Split(Regex(pattern), how).pre_tokenize_str
    kinds = (r"\p{L}", r"\p{N}", r"\s")
    theirs = np.zeros(len(every), np.int8)
    runs = split("|".join(f"{k}+" for k in kinds), "isolated")(every)
    firsts = "".join(every[a] for _, (a, _) in runs)
    for i, k in enumerate(kinds, 1):
        hits = np.zeros(len(firsts), bool)
        for _, (a, b) in pre_tokenizers.Split(Regex(f"{k}+"), "removed", invert=True).pre_tokenize_str(firsts):
            hits[a:b] = True
        for at in np.flatnonzero(hits).tolist():
            theirs[slice(*runs[at][1])] = i
    ours = np.zeros(len(every), np.int8)
    for i, k in enumerate((r"\p{L}", r"\p{N}", f"[{SPACE}]"), 1):
        for m in regex.finditer(f"{k}+", every):
            ours[slice(*m.span())] = i
    odd = theirs != ours
    odd |= np.fromiter((c == "Cn" for c in map(unicodedata.category, every)), bool, len(every))
    lines = every.replace("\n", "")
    lowered = normalizers.Lowercase().normalize_str("\n".join(lines)).split("\n")
    for c, low in zip(lines, lowered, strict=True):
        if c.lower() != low:
            odd[every.index(c)] = True
    for c in normalizers.NFD().normalize_str("\n".join(lines)).split("\n"):
        if unicodedata.normalize("NFD", c) != c:  # pairs that the library knows nothing of
            odd[[every.index(x) for x in (*c, *unicodedata.normalize("NFD", c))]] = True
    codes = np.fromiter(map(ord, every), np.int64, len(every))[odd]
    cuts = np.flatnonzero(np.diff(codes) > 1)
    return tuple(zip(codes[np.append(0, cuts + 1)].tolist(), codes[np.append(cuts, -1)].tolist(), strict=True))


class Unlike:
    """Whether a text has a character of the ranges: one search by a bitmap for those under U+10000, and a
    look at each different character from there on."""

    def __init__(self, ranges: Ranges) -> None:
        low = [f"\\u{a:04x}-\\u{min(b, 0xFFFF):04x}" for a, b in ranges if a < 0x10000]
        self.search = re.compile(f"[{''.join(low)}\\U00010000-\\U0010ffff]").search
        self.low = re.compile(f"[{''.join(low)}]").search
        self.high = re.compile("[\U00010000-\U0010ffff]+").findall
        self.starts, self.ends = [a for a, _ in ranges], [b for _, b in ranges]

    def _one(self, c: str) -> bool:
        at = bisect_right(self.starts, ord(c)) - 1
        return at >= 0 and ord(c) <= self.ends[at]

    def __call__(self, text: str) -> bool:
        first = self.search(text)
        if first is None:
            return False
        return first[0] < "\U00010000" or any(map(self._one, set("".join(self.high(text))))) or self.low(text) is not None


class WordBPE:
    """The encoder of one tokenizer file with word ends."""

    def __init__(self, path: str, ranges: Ranges) -> None:
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = [""] * (max([*self.vocab.values(), *self.added.values()]) + 1)
        for word, at in [*self.vocab.items(), *self.added.items()]:
            self.strings[at] = word
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((self.vocab[a], self.vocab[b]), (rank, self.vocab[a + b]))
        letters = byte_letters()
        self.inner = [self.vocab.get(c) for c in letters]
        self.last = [self.vocab.get(c + self.suffix) for c in letters]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}"))
        self.unlike = Unlike(ranges)
        self.normalizer = Tokenizer.from_file(path).normalizer
        self.their_split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.cache = Remembered(CACHE)

    def merge(self, ids: list[int]) -> list[int]:
        """All merges of a word's symbols."""
        n, merges = len(ids), self.merges
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [(found[0], i, found[1]) for i in range(n - 1) if (found := merges.get((ids[i], ids[i + 1])))]
        heapify(queue)
        while queue:
            rank, i, new = heappop(queue)
            j = after[i]
            if ids[i] < 0 or j < 0 or merges.get((ids[i], ids[j])) != (rank, new):
                continue  # stale
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if found := merges.get((new, ids[k])):
                    heappush(queue, (found[0], i, found[1]))
            if (p := before[i]) >= 0 and (found := merges.get((ids[p], new))):
                heappush(queue, (found[0], p, found[1]))
        return [x for x in ids if x >= 0]

    def word(self, word: str) -> bytes:
        """The ids of one pre-token, as little-endian unsigned 32-bit integers."""
        raw = word.encode()
        inner = self.inner
        ids = [inner[b] for b in raw[:-1]]
        ids.append(self.last[raw[-1]])
        ids = [x for x in ids if x is not None]
        return array("I", self.merge(ids) if len(ids) > 1 else ids).tobytes()

    def chunk(self, chunk: str) -> bytes:
        """The ids of a string without white space."""
        word = self.word
        return b"".join([word(w) for w in self.split.findall(chunk)])

    def _plain(self, text: str) -> list[bytes]:
        if not text.isascii():
            if self.unlike(text):
                theirs = self.their_split.pre_tokenize_str(self.normalizer.normalize_str(text))
                return [self.word(w) for w, _ in theirs]
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if any(c in text for c in ODD_SPACE):
            return [self.word(w) for w in self.split.findall(text)]
        chunks, parts = self.cache, text.split()
        out = list(map(chunks.young.get, parts))
        if None in out:
            for i, found in enumerate(out):
                if found is None:
                    part = parts[i]
                    found = chunks.young.get(part) or chunks.missed(part)
                    if found is None:
                        found = self.chunk(part)
                        if len(part) <= LONG:
                            chunks.put(part, found)
                    out[i] = found
        return out

    def encode(self, text: str) -> bytes:
        out: list[bytes] = []
        parts = self.special.split(text) if "<|" in text else [text]
        for i, part in enumerate(parts):
            if i % 2:
                out.append(self.added[part].to_bytes(4, "little"))
            elif part:
                out += self._plain(part)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        found = array("I")
        found.frombytes(ids)
        return " ".join(map(self.strings.__getitem__, found))


@lru_cache(maxsize=2)
def load(path: str, ranges: Ranges | None = None) -> WordBPE:
    return WordBPE(path, unlike() if ranges is None else ranges)


def _encode(path: str, ranges: Ranges, texts: pa.Array) -> pa.Array:
    model = load(path, ranges)
    return pa.array([model.encode(t) if t else b"" for t in texts.to_pylist()], pa.binary())


def _decode(path: str, ranges: Ranges, ids: pa.Array) -> pa.Array:
    model = load(path, ranges)
    return pa.array([None if x is None else model.decode(x) for x in ids.to_pylist()], pa.string())


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Adds the ids of each text, as little-endian unsigned 32-bit integers."""
    bound_batches(df.sparkSession)
    ranges = unlike()

    def run(texts: pa.Array) -> pa.Array:
        return _encode(path, ranges, texts)

    return df.withColumn(out, F.arrow_udf(run, "binary")(df[text]))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the decoded text of each row's ids."""
    bound_batches(df.sparkSession)
    ranges = unlike()

    def run(column: pa.Array) -> pa.Array:
        return _decode(path, ranges, column)

    return df.withColumn(out, F.arrow_udf(run, "string")(F.col(ids)))
