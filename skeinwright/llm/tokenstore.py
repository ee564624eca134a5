"""Token-ID files: Simple-8b words with escapes and per-block offsets.

Layout of a file (little-endian): the magic ``SKW8B001``; blocks; the document table; the block index;
and a trailer of table offset, index offset, block count and magic. A block holds ``BLOCK`` ids (the last
may hold fewer), across document bounds: counts of ids, of different ids, of lanes and of words, the
block's different ids by falling frequency, the words of each lane of ``LANE`` ids, and 64-bit words that
code each id as its place in that list. The top four bits
of a word are its selector: ``COUNTS[s]`` values of ``BITS[s]`` bits each, the first lowest; selector
``ESCAPE`` says that the next whole word is one value. The document table is an Arrow stream of
(key, n_tokens) in the order written; the index has each block's offset, so blocks are decoded apart,
and within a block all words of one selector are decoded at once.

Documents are range-partitioned and sorted by key, one file for each partition, which is written under
another name and then renamed, so a repeated task leaves the same file.

Defined results: a null or empty text has the end id alone; null keys come first; rows equal in key are
ordered by their text, so the whole result is the same each time; an empty table gives no documents.
Very long texts are cut into many blocks. Only the named columns are read.
"""

from __future__ import annotations

import json
import string
import struct
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import SPACE, Ranges, Unlike, byte_letters, unlike
from .common import Remembered, bound_batches, fresh_path, materialize

MAGIC = b"SKW8B001"
BLOCK, LANE = 1 << 16, 1024
#: Fixed values of the coding: how many values a word of each selector holds, and their bits.
COUNTS = [60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1]
BITS = [1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60]
ESCAPE = 14
#: White space other than the space and the newline (a fixed value).
RARE_SPACE = "\t\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
RARE_ASCII = "\t\x0b\x0c\r"
MARKS = string.punctuation
CACHE = 600_000
LONG = 64


@lru_cache(maxsize=1)
def _widths() -> np.ndarray:
    """The bits of each number under 2**17."""
    return np.frexp(np.arange(1 << 17))[1].astype(np.uint8)


def _width(values: np.ndarray) -> np.ndarray:
    if not len(values) or values.max() < 1 << 17:
        return _widths()[values.astype(np.int64)]
    return sum((values >> np.uint64(k) > 0).astype(np.uint8) for k in range(64))


def pack(values: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """Simple-8b words of unsigned 64-bit values, and the words of each lane.

    Each ``lane`` values are coded apart, each word as full as the next of them allow; the last word of
    a lane is filled with zeros. All lanes are coded in step, a word of each at a time.
    """
    n = len(values)
    lanes, wide = -(-n // lane), lane + COUNTS[0]
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    cells = np.zeros((lanes, wide), np.uint64)
    flat = np.zeros(lanes * lane, np.uint64)
    flat[:n] = values
    cells[:, :lane] = flat.reshape(lanes, lane)
    cells = cells.reshape(-1)
    runs = {1: _width(cells)}
    for size in (2, 4, 8, 16, 32):  # runs[size][i]: the widest of the next `size` values
        half = runs[size // 2]
        runs[size] = half.copy()
        np.maximum(half[: -size // 2], half[size // 2 :], out=runs[size][: -size // 2])
    choice = np.full(len(cells), ESCAPE, np.uint8)
    for s in range(len(COUNTS) - 1, -1, -1):
        whole = 1 << (COUNTS[s].bit_length() - 1)
        widest, shift = runs[whole], COUNTS[s] - whole
        if shift:
            widest = widest.copy()
            np.maximum(widest[:-shift], runs[whole][shift:], out=widest[:-shift])
        choice[widest <= BITS[s]] = s
    ahead = np.array([*COUNTS, 1])[choice]
    at = np.arange(lanes) * wide
    end = at + np.minimum(lane, n - np.arange(lanes) * lane)
    starts, owners, live = [], [], np.arange(lanes)
    while len(live):
        now = at[live]
        starts.append(now)
        owners.append(live)
        now = now + ahead[now]
        at[live] = now
        live = live[now < end[live]]
    start = np.sort(np.concatenate(starts))
    sel = choice[start]
    words = sel.astype(np.uint64) << np.uint64(60)
    for s in np.unique(sel).tolist():
        if s != ESCAPE:
            mine = np.flatnonzero(sel == s)
            step = np.arange(COUNTS[s])
            parts = cells[start[mine][:, None] + step] << (step * BITS[s]).astype(np.uint64)
            words[mine] |= np.bitwise_or.reduce(parts, axis=1)
    counts = np.bincount(np.concatenate(owners), minlength=lanes)
    escaped = np.flatnonzero(sel == ESCAPE)
    if len(escaped):
        words = np.insert(words, escaped + 1, cells[start[escaped]])
        counts += np.bincount(start[escaped] // wide, minlength=lanes)
    return words, counts


def unpack(words: np.ndarray, counts: np.ndarray, n: int, lane: int = LANE) -> np.ndarray:
    """The ``n`` values of Simple-8b words, all words of a selector at once."""
    lanes, wide = len(counts), lane + COUNTS[0]
    sel = (words >> np.uint64(60)).astype(np.uint8)
    raw = np.zeros(len(words), bool)
    for m in np.flatnonzero(sel == ESCAPE).tolist():  # a raw word can look like an escape
        if not raw[m]:
            raw[m + 1] = True
    if (sel[~raw] > ESCAPE).any():
        raise ValueError("unknown selector")
    held = np.array([*COUNTS, 0, 0])[sel]
    held[raw] = 1
    first = np.cumsum(held) - held
    owner = np.repeat(np.arange(lanes), counts)
    base = first[np.cumsum(counts) - counts] if len(words) else first
    first += (np.arange(lanes) * wide - base)[owner]
    out = np.zeros(lanes * wide, np.uint64)
    out[first[raw]] = words[raw]
    for s in np.unique(sel[~raw]).tolist():
        if s != ESCAPE:
            mine = np.flatnonzero((sel == s) & ~raw)
            step = np.arange(COUNTS[s])
            mask = np.uint64((1 << BITS[s]) - 1)
            out[first[mine][:, None] + step] = (words[mine][:, None] >> (step * BITS[s]).astype(np.uint64)) & mask
    return out.reshape(lanes, wide)[:, :lane].reshape(-1)[:n]


def encode_block(ids: np.ndarray) -> bytes:
    """One block of unsigned 32-bit ids."""
    if len(ids) and ids.max() < 1 << 20:
        often = np.bincount(ids)
        distinct = np.flatnonzero(often)
        distinct = distinct[np.argsort(-often[distinct], kind="stable")]
        rank = np.zeros(len(often), np.uint64)
        rank[distinct] = np.arange(len(distinct), dtype=np.uint64)
        places = rank[ids]
    else:
        distinct, inverse, often = np.unique(ids, return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")
        rank = np.empty(len(order), np.uint64)
        rank[order] = np.arange(len(order), dtype=np.uint64)
        distinct, places = distinct[order], rank[inverse]
    words, counts = pack(places)
    head = struct.pack("<IIII", len(ids), len(distinct), len(counts), len(words))
    return head + distinct.astype("<u4").tobytes() + counts.astype("<u4").tobytes() + words.astype("<u8").tobytes()


def decode_block(raw: bytes) -> np.ndarray:
    n, distinct, lanes, words = struct.unpack_from("<IIII", raw)
    ids = np.frombuffer(raw, "<u4", distinct, 16)
    counts = np.frombuffer(raw, "<u4", lanes, 16 + 4 * distinct).astype(np.int64)
    return ids[unpack(np.frombuffer(raw, "<u8", words, 16 + 4 * (distinct + lanes)), counts, n).astype(np.int64)]


class Writer:
    """Writes one file; ids go out as blocks fill, so only the document table grows."""

    def __init__(self, out, key_type: pa.DataType, block: int = BLOCK) -> None:
        self.out, self.block, self.at = out, block, 0
        self.key_type, self.keys, self.sizes = key_type, [], []
        self.offsets: list[int] = []
        self.pending: list[np.ndarray] = []
        self.held = 0
        self._put(MAGIC)

    def _put(self, raw: bytes) -> None:
        self.out.write(raw)
        self.at += len(raw)

    def _flush(self, least: int) -> None:
        if self.held >= least:
            ids = np.concatenate(self.pending)
            cut = len(ids) - len(ids) % self.block if least > 1 else len(ids)
            for k in range(0, cut, self.block):
                self.offsets.append(self.at)
                self._put(encode_block(ids[k : min(cut, k + self.block)]))
            self.pending = [ids[cut:]]
            self.held = len(ids) - cut

    def add(self, key, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.sizes.append(len(ids))
        self.pending.append(ids)
        self.held += len(ids)
        self._flush(self.block)

    def close(self) -> None:
        self._flush(1)
        table_at = self.at
        docs = pa.table({"key": pa.array(self.keys, self.key_type), "n_tokens": pa.array(self.sizes, pa.int64())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, docs.schema) as stream:
            stream.write_table(docs)
        self._put(sink.getvalue().to_pybytes())
        index_at = self.at
        self._put(np.array(self.offsets, "<u8").tobytes())
        self._put(struct.pack("<QQQ", table_at, index_at, len(self.offsets)) + MAGIC)


def read_file(f) -> Iterator[tuple[object, np.ndarray]]:
    """(key, ids) of each document of an open file, block by block."""
    size = f.size()
    f.seek(size - 32)
    table_at, index_at, blocks = struct.unpack("<QQQ", f.read(24))
    if f.read(8) != MAGIC:
        raise ValueError("not a token file")
    f.seek(table_at)
    docs = pa.ipc.open_stream(f.read(index_at - table_at)).read_all()
    offsets = [*np.frombuffer(f.read(8 * blocks), "<u8").tolist(), table_at]
    at, held, have = 0, [], 0
    for key, n in zip(docs["key"].to_pylist(), docs["n_tokens"].to_pylist(), strict=True):
        while have < n:
            f.seek(offsets[at])
            held.append(decode_block(f.read(offsets[at + 1] - offsets[at])))
            have += len(held[-1])
            at += 1
        whole = held[0] if len(held) == 1 else np.concatenate(held) if held else np.empty(0, np.uint32)
        yield key, whole[:n]
        held, have = [whole[n:]], have - n


class ByteBPE:
    """The tokenizer library's model of a byte-level file, asked once for each different pre-token."""

    def __init__(self, path: str, ranges: Ranges) -> None:
        from tokenizers import Tokenizer

        self.unlike = Unlike(ranges)
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        with open(path, encoding="utf-8") as f:
            self.added = [t["content"] for t in json.load(f)["added_tokens"]]
        self.split = regex.compile(
            rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
        )
        # a space between two characters that aren't white space always begins a pre-token
        self.blanks = regex.compile(rf"(?<=[^{SPACE}]) (?=[^{SPACE}])")
        self.uneven = regex.compile(rf"[{SPACE}] | [{SPACE}]|^ | $")
        self.letters = {b: c for b, c in enumerate(byte_letters())}
        self.words = Remembered(CACHE)

    def _word(self, word: str) -> bytes:
        found = self.words.young.get(word) or self.words.missed(word)
        if found is None:
            shown = word.encode().decode("latin-1").translate(self.letters)
            found = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
            if len(word) <= LONG:
                self.words.put(word, found)
        return found

    def _chunk(self, chunk: str) -> bytes:
        if not chunk.isascii() and self.unlike(chunk):
            return np.array(self.library.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self._word, self.split.findall(chunk)))

    def _after(self, part: str) -> bytes:
        """The ids of what follows a space, with the space."""
        core = part.rstrip(MARKS)
        if core.isascii() and core.isalpha():  # letters, then marks: two pre-tokens, without a search
            found = self._word(" " + core)
            return found if len(core) == len(part) else found + self._word(part[len(core) :])
        return self._chunk(" " + part)

    def _even(self, text: str) -> bool:
        """Whether each space stands between two characters that aren't white space."""
        if text.startswith(" ") or text.endswith(" ") or "  " in text or " \n" in text or "\n " in text:
            return False
        rare = RARE_ASCII if text.isascii() else RARE_SPACE
        return not (any(c in text for c in rare) and self.uneven.search(text))

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as ``library.encode(text, add_special_tokens=False)`` has them.

        Texts of even spaces are split together, and each different part of them is looked up once."""
        out: list[np.ndarray | None] = [None] * len(texts)
        even = []
        for i, text in enumerate(texts):
            if any(a in text for a in self.added):
                out[i] = np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
            elif self._even(text):
                even.append(i)
            else:
                first, *rest = self.blanks.split(text)
                out[i] = np.frombuffer(self._chunk(first) + b"".join(map(self._after, rest)), "<u4")
        if even:
            parts = pc.split_pattern(pa.array([texts[i] for i in even], pa.large_string()), " ")
            coded = parts.values.dictionary_encode()
            known = pa.array(map(self._after, coded.dictionary.to_pylist()), pa.large_binary())
            made = known.take(coded.indices)
            _, offsets, data = made.buffers()
            at = np.frombuffer(offsets, "<i8")[: len(made) + 1] // 4
            ids = np.frombuffer(data, "<u4", at[-1])
            bounds = parts.offsets.to_numpy()
            starts, ends = at[bounds[:-1] + 1].tolist(), at[bounds[1:]].tolist()
            for i, start, end in zip(even, starts, ends, strict=True):  # no space before a text's first part
                text = texts[i]
                first = np.frombuffer(self._chunk(text.partition(" ")[0]), "<u4")
                out[i] = np.concatenate([first, ids[start:end]])
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


@lru_cache(maxsize=2)
def load(path: str, ranges: Ranges | None = None) -> ByteBPE:
    return ByteBPE(path, unlike() if ranges is None else ranges)


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file:" + uri.removeprefix("file:"))


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, ranges: Ranges, end_id: int, block: int) -> Iterator[pa.RecordBatch]:
    """Writes this partition's (key, text) rows to one file; yields its line of the manifest."""
    writer, out = None, None
    context = TaskContext.get()
    part = context.partitionId()
    model = load(tokenizer, ranges)
    fs, root = _store(folder)
    own = f"{root}/.part-{part:06d}-{context.taskAttemptId()}-{uuid.uuid4().hex}"
    docs = tokens = 0
    end = np.array([end_id], "<u4")
    for batch in batches:
        if writer is None and batch.num_rows:
            fs.create_dir(root, recursive=True)
            out = fs.open_output_stream(own)
            writer = Writer(out, batch.column(0).type, block)
        texts = [text or "" for text in batch.column(1).to_pylist()]
        for key, ids in zip(batch.column(0).to_pylist(), model.encode_all(texts), strict=True):
            ids = np.concatenate([ids, end])
            writer.add(key, ids)
            docs += 1
            tokens += len(ids)
    if writer is not None:
        writer.close()
        out.close()
        fs.move(own, f"{root}/part-{part:06d}.s8b")
        yield pa.record_batch([pa.array([x], pa.int64()) for x in (part, docs, tokens, writer.at)], ["part", "docs", "tokens", "bytes"])


def write_tokens(df: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 0, block: int = BLOCK) -> list[tuple[int, int, int, int]]:
    """Writes the files and returns the manifest, one (part, documents, ids, bytes) for each file."""
    spark = df.sparkSession
    bound_batches(spark, rows=4096)  # the more texts of a batch, the more often a part is looked up once
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.select(key, text).repartitionByRange(n, key).sortWithinPartitions(key, text)

    ranges = unlike()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _write(batches, folder, tokenizer, ranges, end_id, block)

    manifest = materialize(dealt.mapInArrow(run, "part bigint, docs bigint, tokens bigint, bytes bigint"), "manifest")
    return sorted(map(tuple, manifest.collect()))


def read_tokens(spark: SparkSession, folder: str, manifest: list[tuple[int, int, int, int]], key: T.StructField) -> DataFrame:
    """(key, start, n_tokens, ids) of each document; ids as little-endian unsigned 32-bit integers.

    ``start`` counts the ids of all documents before it, over all files."""
    starts, total = [], 0
    for part, _, tokens, _ in manifest:
        starts.append((part, total))
        total += tokens
    schema = T.StructType([T.StructField(key.name, key.dataType), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    if not starts:
        return spark.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _store(folder)
        for batch in batches:
            for i in batch.column(0).to_pylist():
                part, start = starts[i]
                with fs.open_input_file(f"{root}/part-{part:06d}.s8b") as f:
                    rows, held, kind = [], 0, pa.ipc.open_stream(_table(f)).schema.field("key").type
                    for k, ids in read_file(f):
                        rows.append((k, start, len(ids), ids.astype("<u4").tobytes()))
                        start += len(ids)
                        held += 4 * len(ids)
                        if held > 8 << 20 or len(rows) >= 1024:
                            yield _rows(rows, kind, key.name)
                            rows, held = [], 0
                    if rows:
                        yield _rows(rows, kind, key.name)

    return spark.range(0, len(starts), 1, len(starts)).mapInArrow(run, schema)


def _table(f) -> bytes:
    f.seek(f.size() - 32)
    table_at, index_at, _ = struct.unpack("<QQQ", f.read(24))
    f.seek(table_at)
    return f.read(index_at - table_at)


def _rows(rows: list[tuple], kind: pa.DataType, name: str) -> pa.RecordBatch:
    keys, starts, sizes, ids = zip(*rows, strict=True)
    return pa.record_batch(
        [pa.array(keys, kind), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
        [name, "start", "n_tokens", "ids"],
    )


def token_store(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 0) -> DataFrame:
    """Encodes, writes to a fresh folder of the shared one, and reads the files back."""
    folder = fresh_path(df.sparkSession, "tokens")
    manifest = write_tokens(df, folder, tokenizer, key, text, end_id)
    return read_tokens(df.sparkSession, folder, manifest, df.schema[key])
