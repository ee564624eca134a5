"""Benchmark decontamination with an FM-index for each shard of training documents.

A shard is one Arrow batch of documents. Its words are numbered by the benchmark's vocabulary, and every
maximal run of words that the vocabulary has is kept, if it is as long as the shortest window; no other
word can lie inside a window. Over the runs of a shard, joined by separators, a suffix array is built,
its Burrows-Wheeler transform goes into a wavelet matrix, and suffix positions are sampled. All windows
are searched backwards at once; the rows they find walk back to sampled positions; the word spans of the
occurrences are merged for each document.

A benchmark larger than ``BLOCK_BYTES`` is searched in blocks of that size at most, each sent to the
workers by itself, so neither the driver nor a worker holds more than one block's windows.

Defined results: null or empty texts have no words; an item without words has no window; items of fewer
than ``WINDOW`` words are one window; an item with a null id gives hits but is not counted as an item;
items equal in id are one item. An empty benchmark hits nothing. Only named columns are read, and the
result is one new struct column, so other columns stay as they are.
"""

from __future__ import annotations

import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, once

WINDOW = 8
SAMPLE = 8
BLOCK_BYTES = 32 << 20
#: A word: ASCII letters and digits, and every byte of other characters (a fixed value).
WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

RESULT = (
    "struct<n_words:bigint,n_hit:bigint,items:array<string>,"
    "word_spans:array<struct<start:int,end:int>>,byte_spans:array<struct<start:int,end:int>>,cleaned:binary>"
)
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_RESULT = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("word_spans", _SPANS), ("byte_spans", _SPANS), ("cleaned", pa.binary())])


def words(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


class Windows:
    """The different windows of a block of benchmark items: codes, lengths and the items of each."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], size: int = WINDOW) -> None:
        owners: dict[tuple[bytes, ...], set[int]] = {}
        names: dict[str, int] = {}
        for name, text in items:
            found = words(text)
            owner = None if name is None else names.setdefault(name, len(names))
            for k in range(max(1, len(found) - size + 1) if found else 0):
                mine = owners.setdefault(tuple(found[k : k + size]), set())
                if owner is not None:
                    mine.add(owner)
        self.names = list(names)
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for key in owners for w in key}), 1)}
        self.size = size
        self.lengths = np.array([len(k) for k in owners], np.int64)
        self.codes = np.zeros((len(owners), size), np.int32)
        for row, key in enumerate(owners):
            self.codes[row, : len(key)] = [self.vocabulary[w] for w in key]
        held = [sorted(v) for v in owners.values()]
        self.first = np.concatenate([[0], np.cumsum([len(v) for v in held])]).astype(np.int64)
        self.items = np.array(list(chain.from_iterable(held)), np.int64)
        self.least = int(self.lengths.min()) if len(owners) else 0


class WaveletMatrix:
    """Rank and access over small integers, a level for each bit."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.bits, self.ones, self.zeros, self.at = bits, [], [], []
        for level in range(bits - 1, -1, -1):
            bit = (values >> level) & 1
            self.at.append(bit.astype(np.int8))
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int64)]).astype(np.int32))
            self.zeros.append(len(values) - int(self.ones[-1][-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def path(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where the prefix [0, end) of each symbol's level path stops."""
        for level in range(self.bits):
            ones = self.ones[level][ends]
            up = (symbols >> (self.bits - 1 - level)) & 1
            ends = np.where(up == 1, self.zeros[level] + ones, ends - ones)
        return ends

    def access(self, places: np.ndarray) -> np.ndarray:
        out = np.zeros(len(places), np.int64)
        for level in range(self.bits):
            bit = self.at[level][places]
            ones = self.ones[level][places]
            out = out << 1 | bit
            places = np.where(bit == 1, self.zeros[level] + ones, places - ones)
        return out


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The suffixes of ``text`` in order. Zeros are separators, each less than all letters and all
    different (a later one is greater), so equal runs are told apart at their ends. Prefix doubling; each
    round sorts only the suffixes that are still equal."""
    n = len(text)
    blanks = text == 0
    key = np.where(blanks, np.cumsum(blanks), text.astype(np.int64) + n + 1)
    order = np.argsort(key, kind="stable")
    fresh = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    step = 1
    while True:
        bounds = np.flatnonzero(fresh)
        sizes = np.diff(np.append(bounds, n))
        open_ = np.repeat(sizes > 1, sizes)
        places = np.flatnonzero(open_)
        if not len(places):
            return order
        these = order[places]
        follow = these + step  # inside the text: an equal suffix has no separator among its first letters
        second = rank[np.minimum(follow, n - 1)]
        sub = np.lexsort((second, rank[these]))
        these, second = these[sub], second[sub]
        first = rank[these]
        order[places] = these
        split = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        fresh[places] = split
        rank[these] = places[np.maximum.accumulate(np.where(split, np.arange(len(places)), 0))]
        step *= 2


class FMIndex:
    """Backward search and location over a text of letters 1..sigma with separators 0."""

    def __init__(self, text: np.ndarray, sigma: int, sample: int = SAMPLE) -> None:
        order = suffix_order(text)
        n = len(text)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma + 2))])
        bwt = text[order - 1]  # the text ends in a separator, which goes before its first letter
        self.wavelet = WaveletMatrix(bwt.astype(np.int64), max(1, int(sigma).bit_length()))
        # where the path of a symbol begins, at the end of its levels
        symbols = np.arange(sigma + 2)
        self.base = self.wavelet.path(symbols, np.zeros(sigma + 2, np.int64))
        # every sample-th position and the first of each run: a walk never meets a separator
        marked = (order % sample == 0) | (bwt == 0)
        self.marked = marked
        self.before = np.concatenate([[0], np.cumsum(marked)])
        self.sampled = order[marked]
        self.n = n

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.wavelet.path(symbols, ends) - self.base[symbols]

    def search(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, low, high) of the patterns that occur."""
        alive = np.arange(len(codes))
        last = codes[alive, lengths - 1]
        low, high = self.starts[last], self.starts[last + 1]
        at = lengths - 1
        found = []
        while len(alive):
            keep = low < high
            alive, low, high, at = alive[keep], low[keep], high[keep], at[keep]
            whole = at == 0
            found.append((alive[whole], low[whole], high[whole]))
            alive, low, high, at = alive[~whole], low[~whole], high[~whole], at[~whole] - 1
            if len(alive):
                letter = codes[alive, at].astype(np.int64)
                low = self.starts[letter] + self.rank(letter, low)
                high = self.starts[letter] + self.rank(letter, high)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (alive, low, high)

    def locate(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which interval, position in the text) of every row of the intervals."""
        sizes = high - low
        which = np.repeat(np.arange(len(low)), sizes)
        rows = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)
        place, steps = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            done = self.marked[rows[open_]]
            hit = open_[done]
            place[hit] = self.sampled[self.before[rows[hit]]] + steps[hit]
            open_ = open_[~done]
            letter = self.wavelet.access(rows[open_])
            rows[open_] = self.starts[letter] + self.rank(letter, rows[open_])
            steps[open_] += 1
        return which, place


def occurrences(codes: np.ndarray, ends: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(window, first word) of every occurrence in a shard's words; documents end at ``ends``."""
    known = codes > 0
    edge = np.zeros(len(codes) + 1, bool)
    edge[0] = True
    edge[ends] = True
    begin = np.flatnonzero(known & (edge[:-1] | ~np.concatenate([[False], known[:-1]])))
    stop = np.flatnonzero(known & (edge[1:] | ~np.concatenate([known[1:], [False]]))) + 1
    long_ = stop - begin >= max(1, windows.least)
    begin, stop = begin[long_], stop[long_]
    none = np.empty(0, np.int64)
    if not len(begin):
        return none, none
    sizes = stop - begin + 1  # with a separator behind each run
    offset = np.cumsum(sizes) - sizes
    source = np.repeat(begin - offset, sizes) + np.arange(int(sizes.sum()))
    text = np.where(source < np.repeat(stop, sizes), codes[np.minimum(source, len(codes) - 1)], 0)
    index = FMIndex(text, len(windows.vocabulary))
    pattern, low, high = index.search(windows.codes, windows.lengths)
    which, place = index.locate(low, high)
    return pattern[which], source[place]


def cut(text: bytes, spans: list[dict]) -> bytes:
    """The text without the spans."""
    out, at = [], 0
    for s in spans:
        out.append(text[at : s["start"]])
        at = s["end"]
    return b"".join([*out, text[at:]])


def scan(texts: list[bytes | None], blocks) -> list[dict]:
    """The result of each document of a shard; ``blocks`` gives the Windows of each block in turn."""
    found = [words(t) for t in texts]
    counts = np.array([len(w) for w in found], np.int64)
    ends = np.cumsum(counts)
    flat = list(chain.from_iterable(found))
    total = len(flat)
    cover = np.zeros(total + 1, np.int64)
    items: list[set[str]] = [set() for _ in texts]
    for windows in blocks:
        if not total or not windows.least:
            del windows
            continue
        codes = np.fromiter(map(windows.vocabulary.get, flat, repeat(0)), np.int32, total)
        window, at = occurrences(codes, ends, windows)
        if not len(at):
            del windows
            continue
        np.add.at(cover, at, 1)
        np.add.at(cover, at + windows.lengths[window], -1)
        doc = np.searchsorted(ends, at, side="right")
        pairs = np.unique(doc * len(windows.lengths) + window)
        doc, window = pairs // len(windows.lengths), pairs % len(windows.lengths)
        size = windows.first[window + 1] - windows.first[window]
        owner = np.repeat(doc, size)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(windows.first[window], size)
        pairs = np.unique(owner * max(1, len(windows.names)) + windows.items[place])
        for d, i in zip((pairs // max(1, len(windows.names))).tolist(), (pairs % max(1, len(windows.names))).tolist(), strict=True):
            items[d].add(windows.names[i])
        del windows  # before the next block is read
    hit = np.cumsum(cover[:-1]) > 0
    begins = ends - counts
    summed = np.concatenate([[0], np.cumsum(hit)])
    n_hit = summed[ends] - summed[begins]
    out = []
    for d, text in enumerate(texts):
        row = {"n_words": int(counts[d]), "n_hit": int(n_hit[d]), "items": sorted(items[d]), "word_spans": [], "byte_spans": [], "cleaned": None}
        if n_hit[d]:
            mask = np.concatenate([[False], hit[begins[d] : ends[d]], [False]])
            edges = np.flatnonzero(mask[1:] != mask[:-1]).tolist()
            places = [m.span() for m in WORD.finditer(text.lower())]
            for a, b in zip(edges[::2], edges[1::2], strict=True):
                row["word_spans"].append({"start": a, "end": b})
                row["byte_spans"].append({"start": places[a][0], "end": places[b - 1][1]})
            row["cleaned"] = cut(text, row["byte_spans"])
        out.append(row)
    return out


def _blocks(benchmark: DataFrame, item: str, text: str, size: int, block_bytes: int):
    """Broadcasts of Windows, each of a block of at most about ``block_bytes`` of item texts."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).cast("binary").alias("t"))
    volume = rows.agg(F.sum(F.coalesce(F.octet_length("t"), F.lit(0)) + 64)).head()[0] or 0
    n = max(1, -(-2 * volume // block_bytes)) if volume > block_bytes else 1
    for k in range(n):
        part = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("i"), F.lit(n)) == k)
        yield spark.sparkContext.broadcast(Windows([(r.i, None if r.t is None else bytes(r.t)) for r in part.sort("i", "t").toLocalIterator()], size))


def _values(blocks: list):
    """The value of each broadcast in turn. Of several, each is let go before the next is read: a broadcast
    keeps its value in the worker, and reads it from the worker's disk again where it has none."""
    for b in blocks:
        value = b.value
        if len(blocks) > 1:
            del b._value
        yield value
        del value


def decontaminate(df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", out: str = "leaks", size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Adds a RESULT struct: counts, items that occur, the merged spans to remove, and for texts with such
    spans the text without them."""
    bound_batches(df.sparkSession)
    blocks = list(_blocks(benchmark, item, item_text, size, block_bytes))

    def run(texts: pa.Array) -> pa.Array:
        return pa.array(scan(texts.to_pylist(), _values(blocks)), _RESULT)

    return df.withColumn(out, once(run, RESULT)(F.col(text).cast("binary")))


def remove_spans(df: DataFrame, text: str = "text", leaks: str = "leaks") -> DataFrame:
    """The text column without its removal spans."""
    return df.withColumn(text, F.coalesce(F.col(f"{leaks}.cleaned").cast("string"), F.col(text)))
