"""WARC derivatives: linked metadata and plain-text conversion records for response records.

Records are rows: ``type, record_id, target_uri, date, content_type, headers`` (all named fields as a map; a field that is
repeated has its values in one entry, with a line feed between), ``block`` (bytes) and ``damaged``. Files are read and
written with Spark's text source, so large files are split between tasks, whatever their WARC version, gzip files are
streamed, and any path that Spark can open will do: what stands between two records is the line separator. Files in which
a line is not just one whole record, because the separator occurs in its data or it is cut short, are read again: their
lines are brought into order, one task a file, and lines are joined until a record has its Content-Length. At most one
record's lines are held there. A record whose length is not met so, or that is followed by bytes that are no record, is
marked damaged and has no derivatives; it stays in the table, and the lines behind it are read as records again.

Each sound response gives a ``metadata`` record (JSON: the source's WARC fields, status and HTTP headers, title, meta
tags, links) and a ``conversion`` record (all visible text). Both carry WARC-Refers-To with the source's id, its target
URI and date, its digests under WARC-Source-* names, and digests of their own. Ids are derived from the source's id, so
that reruns agree.

Bodies are decoded whole from chunked transfer and from gzip, of all members, or deflate; the metadata say so where the
stored body ends early or is not what its headers name. Text is read by the charset of the HTTP header, of a meta tag,
or UTF-8, and wrong bytes become U+FFFD.

Defined cases: a null block is empty; a response without an HTTP header is all body; a null target URI stays out of the
headers; records of other types have no derivatives; repeated rows give repeated derivatives; an empty table gives an
empty result. Columns beside those of a record are left out, except those named in ``keep``.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence
from html import unescape
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lotbook.llm.main_text import blocks, tokens
from lotbook.sources.scratch import save_counted

VERSION = "WARC/1.0"
#: Derivatives are handed on when their blocks reach this many bytes together.
BATCH_BYTES = 32 << 20
RECORD = T.StructType([
    T.StructField("type", T.StringType()), T.StructField("record_id", T.StringType()),
    T.StructField("target_uri", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("content_type", T.StringType()), T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("block", T.BinaryType()), T.StructField("damaged", T.BooleanType()),
])
_FIELDS = {"WARC-Type": "type", "WARC-Record-ID": "record_id", "WARC-Target-URI": "target_uri", "WARC-Date": "date",
           "Content-Type": "content_type"}
SEPARATOR = "\r\n\r\nWARC/"
LARGEST = (1 << 31) - 1  # bytes that a row can hold
_VERSION = re.compile(rb"(?:WARC/)?[0-9]+\.[0-9]+\r\n")
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def derived_id(kind: str, source: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{kind} {source}')}>"


def parse_headers(text: str) -> list[tuple[str, str]]:
    """Named fields in order; a line that starts with white space continues the one before."""
    out: list[tuple[str, str]] = []
    for line in text.replace("\r\n", "\n").split("\n"):
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            out.append((name.strip(), value.strip()))
    return out


def _fields(pairs: Sequence[tuple[str, str]]) -> dict[str, str]:
    """Fields by the name they have first; values of a repeated field are joined."""
    names: dict[str, str] = {}
    out: dict[str, str] = {}
    for name, value in pairs:
        name = names.setdefault(name.lower(), name)
        out[name] = f"{out[name]}\n{value}" if name in out else value
    return out


def _claimed(raw: bytes) -> tuple[int, int | None]:
    """Where a record's block begins, and the length it should have, None if it names none that can be."""
    border = raw.find(b"\r\n\r\n")
    fields = _fields(parse_headers(raw[: border if border >= 0 else len(raw)].decode("utf-8", "replace")))
    size = {n.lower(): v for n, v in fields.items()}.get("content-length", "")
    known = size.isascii() and size.isdigit() and len(size) < 11 and int(size) <= LARGEST
    return (border + 4 if border >= 0 else len(raw)), int(size) if known else None


def _state(raw: bytes) -> int:
    """Of a record and what follows it: 0 if it is whole, below 0 if bytes are missing, above 0 if it can't be whole."""
    first, size = _claimed(raw)
    if size is None:
        return 1
    surplus = raw[first + size :]
    return -1 if len(raw) < first + size else 1 if surplus.strip(b"\r\n") else 0


def parse_record(raw: bytes) -> dict:
    """The record that bytes begin with, with or without its version line and the closing line ends."""
    if raw.startswith(b"WARC/"):
        raw = raw[raw.find(b"\r\n") + 2 :]
    first, size = _claimed(raw)
    fields = _fields(parse_headers(raw[:first].decode("utf-8", "replace")))
    names = {n.lower(): n for n in fields}
    out = {column: fields.get(names.get(name.lower(), "")) for name, column in _FIELDS.items()}
    damaged = _state(raw) != 0
    block = raw[first:] if damaged else raw[first : first + size]
    return {**out, "headers": fields, "block": block, "damaged": damaged}


def parse_lines(lines: Iterable[bytes]) -> Iterator[dict]:
    """The records of a file's lines in order, lines that belong to one record joined again.

    If a record's length is not met at the end of any line, its first line is a damaged record, and those behind are
    looked at again.
    """
    lines = iter(lines)
    held: list[bytes] = []
    ends: list[int] = []  # where each line held ends in the file
    at = 0

    def read() -> bool:
        line = next(lines, None)
        if line is not None:
            held.append(line)
            ends.append((ends[-1] + len(SEPARATOR) if ends else 0) + len(line))
        return line is not None

    while at < len(held) or read():
        line = held[at]
        body = _body(line)
        first, claimed = _claimed(body)
        stop = at
        if claimed is not None:
            end = ends[at] - len(body) + first + claimed
            while ends[-1] < end and read():
                pass
            stop = bisect_left(ends, end, at)
        surplus = ends[stop] - end if claimed is not None and stop < len(ends) else -1
        if 0 <= surplus <= len(held[stop]) and not held[stop][len(held[stop]) - surplus :].strip(b"\r\n"):
            yield parse_record(_body(SEPARATOR.encode().join(held[at : stop + 1])))
            at = stop + 1
        else:
            yield parse_record(body)
            at += 1
        if at > 64:
            # The last line stays, as the next one's place follows from it.
            gone = min(at, len(held) - 1)
            del held[:gone], ends[:gone]
            at -= gone


def _body(line: bytes) -> bytes:
    """A line without the version it begins with."""
    found = _VERSION.match(line)
    return line[found.end() :] if found else line


def format_record(record: dict) -> bytes:
    """The record without the two line ends behind it."""
    fields = dict(record["headers"] or {})
    for name, column in _FIELDS.items():
        if record[column] is not None:
            fields[name] = record[column]
    block = bytes(record["block"] or b"")
    fields["Content-Length"] = str(len(block))
    lines = [VERSION, *[f"{name}: {value}" for name, values in fields.items() for value in values.split("\n")]]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files of any version, plain or gzip."""
    lines = spark.read.option("lineSep", SEPARATOR).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"), F.col("value").cast("binary").alias("raw"))

    def broken(batches):
        for batch in batches:
            states = [_state(_body(raw.as_py())) for raw in batch.column("raw") if raw.as_py().strip(b"\r\n")]
            files = [f for f, raw in zip(batch.column("file").to_pylist(), batch.column("raw"), strict=True)
                     if raw.as_py().strip(b"\r\n")]
            found = sorted({f for f, state in zip(files, states, strict=True) if state})
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["file"])

    def single(batches):
        for batch in batches:
            for raw in batch.column("raw"):
                if raw.as_py().strip(b"\r\n"):
                    yield _batch([parse_record(_body(raw.as_py()))], RECORD, {})

    def joined(batches):
        rows = ((file, raw) for batch in batches
                for file, raw in zip(batch.column("file").to_pylist(), batch.column("raw"), strict=True))
        for _, own in groupby(rows, key=lambda row: row[0]):
            raws = (raw.as_py() for _, raw in own)
            for record in parse_lines(raw for raw in raws if raw.strip(b"\r\n")):
                yield _batch([record], RECORD, {})

    schema = T.StructType([T.StructField("file", T.StringType())])
    files, n_files = save_counted(lines.select("file", "raw").mapInArrow(broken, schema).distinct(), "files")
    if not n_files:
        return lines.select("raw").mapInArrow(single, RECORD)
    whole = lines.join(files, "file", "left_anti").select("raw").mapInArrow(single, RECORD)
    ordered = lines.join(files, "file", "left_semi").repartition("file").sortWithinPartitions("file", "start", "place")
    return whole.unionByName(ordered.select("file", "raw").mapInArrow(joined, RECORD))


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """One file per partition."""
    schema = T.StructType([T.StructField("raw", T.BinaryType())])

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([format_record(r) for r in _rows(batch)], pa.binary())], ["raw"])

    raw = records.select(*RECORD.names).mapInArrow(run, schema)
    raw.select(F.col("raw").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").option(
        "compression", compression).text(path)


def _rows(batch: pa.RecordBatch) -> list[dict]:
    return [{**row, "headers": dict(row["headers"] or {})} for row in batch.to_pylist()]


def _batch(records: Sequence[dict], schema: T.StructType, kept: dict[str, pa.Array]) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)
    arrays = []
    for column in arrow:
        if column.name in kept:
            arrays.append(kept[column.name])
        else:
            values = [r[column.name] for r in records]
            if column.name == "headers":
                values = [list(v.items()) for v in values]
            arrays.append(pa.array(values, column.type))
    return pa.RecordBatch.from_arrays(arrays, names=arrow.names)


def responses(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records, with the page's id, for pages that were not stored as records: UTF-8 html, status 200."""
    source = pages.select(F.col(id_col), F.col(url_col).cast("string").alias("_url"),
                          F.col(html_col).cast("string").alias("_html"))
    schema = T.StructType([source.schema[id_col], *RECORD.fields])

    def run(batches):
        for batch in batches:
            found = []
            for key, url, html in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                body = (html or "").encode()
                block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}"
                         "\r\n\r\n").encode() + body
                found.append({
                    "type": "response", "record_id": derived_id("response", f"{key} {url} {digest(body)}"),
                    "target_uri": url, "date": date, "content_type": "application/http; msgtype=response",
                    "headers": {"WARC-Payload-Digest": digest(body), "WARC-Block-Digest": digest(block)},
                    "block": block, "damaged": False})
            yield _batch(found, schema, {id_col: batch.column(0)})

    return source.mapInArrow(run, schema)


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and raw body; a block without a status line is all body."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    head, _, body = block.partition(b"\r\n\r\n")
    status, _, rest = head.decode("latin-1").partition("\r\n")
    return status, parse_headers(rest), body


def _unchunked(body: bytes) -> tuple[bytes, bool]:
    """The chunks' data, and whether the last chunk was reached; a body that does not start with a chunk is as it is."""
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        size = body[at:end].split(b";")[0].strip()
        if not re.fullmatch(rb"[0-9a-fA-F]+", size):
            break
        if not int(size, 16):
            return b"".join(out), True
        out.append(body[end + 2 : end + 2 + int(size, 16)])
        at = end + 4 + int(size, 16)
    return (b"".join(out), False) if out else (body, True)


def _inflated(body: bytes, bits: int) -> tuple[bytes, bool]:
    """All members' data, and whether the last one reached its end; an error if not even the first can be read."""
    out, complete = [], False
    while body:
        stream = zlib.decompressobj(bits)
        try:
            out.append(stream.decompress(body) + stream.flush())
        except zlib.error:
            if not out:
                raise
            return b"".join(out), False
        complete, body = stream.eof, stream.unused_data
        if not body.startswith(b"\x1f\x8b"):
            break  # what follows is padding, no member
    return b"".join(out), complete


def decoded_body(headers: Sequence[tuple[str, str]], body: bytes) -> tuple[bytes, bool]:
    """The body without transfer and content encodings, and whether all of it is there."""
    named = {name.lower(): value.lower() for name, value in headers}
    complete = True
    if "chunked" in named.get("transfer-encoding", ""):
        body, complete = _unchunked(body)
    encoding = named.get("content-encoding", "")
    if body and ("gzip" in encoding or "deflate" in encoding):
        for bits in (47, -15):
            try:
                out, ended = _inflated(body, bits)
                return out, complete and ended
            except zlib.error:
                continue
        return body, False
    return body, complete


def decoded_text(headers: Sequence[tuple[str, str]], body: bytes) -> str:
    named = {name.lower(): value for name, value in headers}
    found = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", named.get("content-type", ""), re.I)
    charset = found[1] if found else None
    if charset is None:
        meta = re.search(rb"<meta[^>]{0,200}charset\s*=\s*[\"']?([\w.:-]+)", body, re.I)
        charset = meta[1].decode("ascii", "replace") if meta else "utf-8"
    try:
        return body.decode(charset, "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


_PAIR = re.compile(r"(?<![\w:-])([\w:-]++)\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>\"']++)")
_LINKS = frozenset("a link img script iframe".split())
_RAW = frozenset("script style textarea title".split())  # no markup inside


def html_metadata(html: str) -> dict:
    """Title, meta tags and links, in page order; comments hold none."""
    def pairs(text: str) -> dict[str, str]:
        return {k.lower(): unescape(v.strip("\"'")) for k, v in _PAIR.findall(text)}

    title, metas, links = None, [], []
    for _, stop, closing, tag, attributes, inner in tokens(html, _RAW):
        if closing:
            continue
        if tag == "title" and title is None:
            title = html[inner : html.rfind("<", inner, stop) if html.endswith(">", inner, stop) else stop]
        elif tag == "meta":
            metas.append(pairs(attributes))
        elif tag in _LINKS:
            found = pairs(attributes)
            if url := found.get("href") or found.get("src"):
                links.append({"path": tag, "url": url})
    return {"title": None if title is None else " ".join(unescape(title).split()), "metas": metas, "links": links}


def derivatives_of(record: dict) -> list[dict]:
    """The metadata and the conversion record of one sound response; none for other records."""
    if record["type"] != "response" or record["damaged"]:
        return []
    source = record["record_id"] or derived_id("response", digest(bytes(record["block"] or b"")))
    status, headers, raw = split_http(bytes(record["block"] or b""))
    body, complete = decoded_body(headers, raw)
    html = decoded_text(headers, body)
    given = record["headers"] or {}
    kept = {f"WARC-Source-{name.removeprefix('WARC-')}": value for name, value in given.items()
            if name in ("WARC-Payload-Digest", "WARC-Block-Digest")}
    code = status.split(" ")[1] if status.count(" ") else None
    warc_fields = {name: value for name, value in given.items()}
    for name, column in _FIELDS.items():
        if record[column] is not None:
            warc_fields[name] = record[column]
    about = {"source_warc_headers": warc_fields, "status_line": status, "status": code, "http_headers": headers,
             "body_bytes": len(raw), "decoded_bytes": len(body), "body_complete": complete,
             "payload_digest": digest(raw), "html": html_metadata(html)}
    text = "\n".join(b.text for b in blocks(html))
    out = []
    for kind, content_type, block in (
        ("metadata", "application/json", json.dumps(about, ensure_ascii=False, sort_keys=True).encode()),
        ("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace")),
    ):
        out.append({"type": kind, "record_id": derived_id(kind, source), "target_uri": record["target_uri"],
                    "date": record["date"], "content_type": content_type, "block": block, "damaged": False,
                    "headers": {"WARC-Refers-To": source, **kept, "WARC-Block-Digest": digest(block)}})
    return out


def derivatives(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Metadata and conversion records of the responses, with the ``keep`` columns of their source."""
    keep = [c for c in keep if c not in RECORD.names]
    schema = T.StructType([*[records.schema[c] for c in keep], *RECORD.fields])

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                owner, found, size = [], [], 0
                for row, record in enumerate(_rows(part.select(RECORD.names))):
                    new = derivatives_of(record)
                    owner += [row] * len(new)
                    found += new
                    size += sum(len(r["block"]) for r in new)
                    if size >= BATCH_BYTES or row == part.num_rows - 1:
                        at = pa.array(owner, pa.int64())
                        yield _batch(found, schema, {c: part.column(c).take(at) for c in keep})
                        owner, found, size = [], [], 0

    return records.select(*keep, *RECORD.names).mapInArrow(run, schema)
