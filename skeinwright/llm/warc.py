"""WARC derivatives: from response records, linked metadata and plain-text conversion records.

A response record is a column of bytes in WARC/1.1 form. ``derive`` parses it, and gives for each one
metadata record (``application/warc-fields``) and one conversion record (``text/plain``). Both name the
response in ``WARC-Refers-To`` (with its target address and date); the metadata record lists the HTTP
status and every header that the source sent, and the digests of the source, and names the conversion
record as related. Record identifiers are derived from the source's identifier, so a repeated task makes
the same records.

Text extraction drops comments, scripts, styles, templates and titles, breaks lines at block elements,
decodes character references, and joins white space within lines.

Defined results: a null response, or one that isn't a response record, gives no records; an empty body
gives an empty conversion; a null page body counts as empty, a null address as an empty one. Repeated
rows give repeated records with the same identifiers. Very long bodies are processed whole.
"""

from __future__ import annotations

import base64
import contextlib
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches

CRLF = b"\r\n"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:skeinwright:warc")
#: Elements that break lines (fixed values).
BLOCKS = frozenset("address article aside blockquote body br caption dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
#: Elements whose content isn't shown (fixed values).
HIDDEN = frozenset("script style template noscript title textarea".split())
_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
_SPACES = re.compile(r"[^\S\n]+")

RECORDS = "array<struct<record_type:string,record_id:string,refers_to:string,target_uri:string,date:string,payload_digest:string,block_digest:string,content_length:bigint,text:string,record:binary>>"


def _tag_end(page: str, at: int) -> int:
    """Behind the end of the tag whose name ends at ``at``; quoted values may hold '>'. -1 if there is none."""
    while True:
        end = page.find(">", at)
        if end < 0:
            return -1
        quote = min((q for q in (page.find('"', at, end), page.find("'", at, end)) if q >= 0), default=-1)
        if quote < 0:
            return end + 1
        close = page.find(page[quote], quote + 1)
        if close < 0:  # a quote that never ends is none
            return end + 1
        at = close + 1


def _cut(page: str) -> Iterator[str]:
    """The parts of a page that are shown, with a line break for each tag of a block; one pass, in which nothing is
    searched again once it is known to be missing."""
    lower, at, size = None, 0, len(page)
    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            yield page[at:]
            return
        yield page[at:begin]
        after = page[begin + 1 : begin + 2]
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = end + 3 if end >= 0 else size
            continue
        if after in ("!", "?") and after:
            end = page.find(">", begin)
            if end < 0:
                yield page[begin:]
                return
            at = end + 1
            continue
        closing = after == "/"
        name = _NAME.match(page, begin + 1 + closing)
        if not name:
            yield "<"
            at = begin + 1
            continue
        end = _tag_end(page, name.end())
        if end < 0:  # no tag ends from here on
            yield page[begin:]
            return
        tag = name[0].lower()
        if tag in BLOCKS:
            yield "\n"
        if tag in HIDDEN and not closing:
            lower = page.lower() if lower is None else lower
            if len(lower) != size:  # a letter whose lower case is longer
                lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in page)
            end = lower.find(f"</{tag}", end)
            if end < 0:
                return
            end = page.find(">", end) + 1
            if not end:
                return
            if tag in BLOCKS:
                yield "\n"
        at = end


def extract_text(page: str) -> str:
    """The visible text of a page, a line for each block."""
    flat = html.unescape("".join(_cut(page.replace("\r", " ").replace("\n", " "))))
    lines = (_SPACES.sub(" ", line).strip() for line in flat.split("\n"))
    return "\n".join(line for line in lines if line)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, '|'.join(parts))}>"


def serialize(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC/1.1 record; Content-Length goes last."""
    lines = [b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in headers), f"Content-Length: {len(block)}".encode()]
    return CRLF.join(lines) + CRLF * 2 + block + CRLF * 2


def _fields(raw: bytes) -> list[tuple[str, str]]:
    """Header lines; a line that begins with white space goes on with the last."""
    out: list[tuple[str, str]] = []
    for line in raw.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif line:
            name, _, value = line.partition(":")
            out.append((name.strip(), value.strip()))
    return out


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by lower-case name, and the block that Content-Length tells."""
    head, found, rest = record.partition(CRLF * 2)
    version, _, lines = head.partition(CRLF)
    if not found or not version.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, v in _fields(lines)}
    return headers, rest[: max(0, int(headers["content-length"]))]


def body_of(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """(status line, headers, body) of an HTTP response: chunks are joined, and gzip and deflate are undone as far
    as they go; a body that is not what the headers say stays as it is."""
    head, _, body = block.partition(CRLF * 2)
    status, _, lines = head.partition(CRLF)
    sent = _fields(lines)
    by_name = {k.lower(): v.lower() for k, v in sent}
    if by_name.get("transfer-encoding") == "chunked":
        parts, at = [], 0
        while True:
            end = body.find(CRLF, at)
            size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
            if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
                break
            parts.append(body[end + 2 : end + 2 + int(size, 16)])
            if not int(size, 16):
                break
            at = end + 4 + int(size, 16)
        body = b"".join(parts) if parts else body
    if by_name.get("content-encoding") in ("gzip", "x-gzip", "deflate"):
        for bits in (47, -15):  # with a header of either kind, or without
            with contextlib.suppress(zlib.error):
                body = zlib.decompressobj(bits).decompress(body)
                break
    return status.decode("utf-8", "replace"), sent, body


def response_record(key: str, address: str, body: bytes, date: str) -> bytes:
    """A response record around a page body, for tables that hold bodies alone."""
    http = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}".encode()]) + CRLF * 2
    block = http + body
    address = re.sub(r"[\r\n]", "", address)
    headers = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", record_id("response", key, address, digest(body))),
        ("WARC-Target-URI", address),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", digest(body)),
        ("WARC-Block-Digest", digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return serialize(headers, block)


def write_records(records: Iterable[bytes], out) -> None:
    """A container: each record is a gzip member of its own, so that it can be read from its offset."""
    for record in records:
        out.write(gzip.compress(record, 6, mtime=0))


def _plain_records(raw: bytes) -> Iterator[bytes]:
    at = 0
    while raw.startswith(b"WARC/", at):
        head = raw.find(CRLF * 2, at)
        size = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)[ \t]*\r?$", raw[at : max(at, head) + 2])
        if head < 0 or not size or head + 4 + int(size[1]) > len(raw):
            return
        end = head + 4 + int(size[1])
        yield raw[at:end] + CRLF * 2
        at = end + 4


def read_records(f, step: int = 1 << 16) -> Iterator[bytes]:
    """The records of an open container, each with its closing line breaks: of a compressed one member by member,
    so that one record is held at a time; a plain one is read whole. A damaged rest is left."""
    raw = f.read(step)
    if raw[:2] != b"\x1f\x8b":
        yield from _plain_records(raw + f.read())
        return
    while raw[:1] == b"\x1f":
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            try:
                parts.append(member.decompress(raw))
            except zlib.error:
                return
            raw = member.unused_data if member.eof else f.read(step)
            if not raw and not member.eof:
                return
        yield from _plain_records(b"".join(parts))
        raw = raw or f.read(step)


def derive_one(record: bytes | None) -> list[dict]:
    """The metadata and the conversion record of a response."""
    if not record:
        return []
    try:
        source, block = parse(record)
    except (ValueError, KeyError):
        return []
    if source.get("warc-type") != "response":
        return []
    status, sent, body = body_of(block)
    kind = dict((k.lower(), v) for k, v in sent).get("content-type", "")
    charset = re.search(r"charset=[\"']?([\w.:-]+)", kind, re.I)
    try:
        page = body.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        page = body.decode("utf-8", "replace")
    own = source.get("warc-record-id", "")
    ids = {k: record_id(k, own) for k in ("metadata", "conversion")}
    payload = source.get("warc-payload-digest") or digest(body)
    text = extract_text(page) if "html" in kind.lower() or not kind else page
    fields = [
        ("conversion", ids["conversion"]),
        ("source-block-digest", source.get("warc-block-digest") or digest(block)),
        ("source-payload-digest", payload),
        ("http-status", status),
        *((f"http-header-{k.lower()}", v) for k, v in sent),
        *((f"source-{k}", v) for k, v in sorted(source.items()) if k not in ("warc-type", "warc-record-id", "content-length", "warc-block-digest", "warc-payload-digest")),
    ]
    blocks = {
        "metadata": ("application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields).encode()),
        "conversion": ("text/plain; charset=utf-8", text.encode("utf-8", "replace")),
    }
    out = []
    for name, (content, raw) in blocks.items():
        other = "conversion" if name == "metadata" else "metadata"
        headers = [
            ("WARC-Type", name),
            ("WARC-Record-ID", ids[name]),
            ("WARC-Refers-To", own),
            ("WARC-Refers-To-Target-URI", source.get("warc-target-uri", "")),
            ("WARC-Refers-To-Date", source.get("warc-date", "")),
            ("WARC-Concurrent-To", ids[other]),
            ("WARC-Target-URI", source.get("warc-target-uri", "")),
            ("WARC-Date", source.get("warc-date", "")),
            ("WARC-Block-Digest", digest(raw)),
            ("Content-Type", content),
        ]
        out.append({
            "record_type": name, "record_id": ids[name], "refers_to": own, "target_uri": source.get("warc-target-uri", ""), "date": source.get("warc-date", ""),
            "payload_digest": payload, "block_digest": digest(raw), "content_length": len(raw), "text": raw.decode(), "record": serialize(headers, raw),
        })
    return out


_RECORDS = pa.list_(pa.struct([(k, {"content_length": pa.int64(), "record": pa.binary()}.get(k, pa.string())) for k in ("record_type", "record_id", "refers_to", "target_uri", "date", "payload_digest", "block_digest", "content_length", "text", "record")]))


def responses(df: DataFrame, key: str = "page_id", address: str = "url", body: str = "html", date: str = "2024-01-01T00:00:00Z", out: str = "response") -> DataFrame:
    """Adds a response record around each page body."""
    bound_batches(df.sparkSession)

    def run(keys: pa.Array, addresses: pa.Array, bodies: pa.Array) -> pa.Array:
        rows = zip(keys.to_pylist(), addresses.to_pylist(), bodies.to_pylist(), strict=True)
        return pa.array([response_record(k or "", a or "", b or b"", date) for k, a, b in rows], pa.binary())

    return df.withColumn(out, F.arrow_udf(run, "binary")(F.col(key).cast("string"), F.col(address), F.col(body).cast("binary")))


def _derive(records: pa.Array) -> pa.Array:
    return pa.array([derive_one(r) for r in records.to_pylist()], _RECORDS)


def derive(df: DataFrame, response: str = "response", out: str = "derived") -> DataFrame:
    """One row for each derived record: the columns of ``df`` but the response, and struct ``out``."""
    bound_batches(df.sparkSession)
    made = F.arrow_udf(_derive, RECORDS)(F.col(response))
    return df.withColumn(out, F.explode(made)).drop(response)
