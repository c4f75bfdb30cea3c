"""WARC archives with a two-level capture index.

Tasks write archives of one gzip member per record into the shared folder and
report where each record lies. The index sorts reversed-host URL keys into
compressed blocks of lines, part files by key range; a part ends with its sparse
block directory (first key, offset and length of each block). A lookup finds
the parts of a key by binary search over their first keys, binary-searches the
directory, reads the blocks in question and then just the bytes of the records.

Files are opened through ``pyarrow.fs`` under the folder that Spark's
checkpoints share. A task that is run again writes files of its own; only files
reported by the attempt that counted are ever read.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import re
import struct
import uuid
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.common import BROADCAST_MAX_BYTES, bounded_broadcast, map_arrow, materialize
from ticketflow.session import scratch_path

MIN_REVISIT_BYTES = 1000
REPEATED_ROW_BYTES = 120
ARCHIVE_BYTES = 1 << 30
BLOCK_LINES = 1000
READ_SPAN = 64 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

MANIFEST = "surt string, page_id bigint, file string, offset bigint, length bigint"


def surt(url: Column) -> Column:
    """Reversed-host key: ``http://a.b.c/x?y`` becomes ``c,b,a)/x?y``.

    Without ``://`` the key is ``)`` and the url, for a null url just ``)``.
    White space that would break an index line is percent-encoded.
    """
    u = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.regexp_extract(u, r"(?s)^.*?://(.*)$", 1))
    host = F.lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    tail = F.substr(rest, F.length(host) + 1)
    key = F.coalesce(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), tail),
                     F.concat(F.lit(")"), u))
    for raw, code in (("\t", "%09"), ("\n", "%0A"), ("\r", "%0D")):
        key = F.replace(key, F.lit(raw), F.lit(code))
    return key


def classify(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES,
             max_broadcast: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Pages with ``payload, payload_digest, record_type, refers_to``.

    Of equal payloads of at least ``min_bytes``, the record with the largest
    page_id is the response and the others revisit it; rows that tie for it are
    all responses. A row without an id revisits like any other; if the whole
    group has none, all are responses. A null html is an empty payload.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    p = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("payload_digest"),
                     F.octet_length(payload).cast("long").alias("payload_bytes"))
    repeated = materialize(
        p.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("last_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("payload_digest", "payload_bytes", "last_id"), "warc-repeated")
    repeated, _ = bounded_broadcast(repeated, REPEATED_ROW_BYTES, max_broadcast)
    revisit = F.col("last_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last_id"))
    return p.join(repeated, ["payload_digest", "payload_bytes"], "left").select(
        "page_id", "url", surt(F.col("url")).alias("surt"), "payload", "payload_digest", "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("last_id")).alias("refers_to"))


def _urn(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_id(urn: str):
    text = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "none" else int(text)


def record_bytes(page_id, url, payload: bytes, digest: str, kind: str, refers_to, date: str = DATE) -> bytes:
    """One WARC/1.0 record; a revisit holds the HTTP head only."""
    block = HTTP_HEAD + (payload if kind == "response" else b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    head.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if kind == "revisit":
        head += [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", PROFILE),
                 ("X-Payload-Length", str(len(payload)))]
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload (of a revisit: empty) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.0":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def write_archives(records: DataFrame, folder: str, max_bytes: int = ARCHIVE_BYTES, level: int = 6) -> DataFrame:
    """Write classified records; the manifest says where each one lies."""
    names = ("page_id", "url", "surt", "payload", "payload_digest", "record_type", "refers_to")

    def write(batches):
        store, base = fs.FileSystem.from_uri(folder)
        out, name, at = None, None, 0
        try:
            for b in batches:
                rows = {k: [] for k in ("surt", "page_id", "file", "offset", "length")}
                for page_id, url, key, payload, digest, kind, refers in zip(
                        *(b.column(c).to_pylist() for c in names)):
                    if out is None or at >= max_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{base}/{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(name, compression=None)
                    member = gzip.compress(record_bytes(page_id, url, payload, digest, kind, refers), level, mtime=0)
                    out.write(member)
                    for k, v in zip(rows, (key, page_id, name, at, len(member))):
                        rows[k].append(v)
                    at += len(member)
                yield rows
        finally:
            if out is not None:
                out.close()

    _make(folder)
    return materialize(map_arrow(records.select(*names), write, MANIFEST), "warc-manifest")


def _make(folder: str) -> None:
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)


@dataclass(frozen=True)
class CaptureIndex:
    """First keys and files of the parts; as many as the sort had partitions."""

    folder: str
    first_keys: tuple[str, ...]
    last_keys: tuple[str, ...]
    files: tuple[str, ...]


def build_index(manifest: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> CaptureIndex:
    """Sort the manifest by key into compressed blocks, a part file for each range.

    Ranges are cut by key, id and place, so a key with very many captures is
    spread over several parts.
    """
    order = ["surt", "page_id", "file", "offset"]
    _make(folder)

    def write(batches):
        store, base = fs.FileSystem.from_uri(folder)
        name = f"{base}/{uuid.uuid4().hex}.cdx"
        out, directory, lines, at, first, last = None, [], [], 0, None, None

        def flush():
            nonlocal at, lines
            block = gzip.compress("".join(lines).encode(), 6, mtime=0)
            directory.append([lines[0].split("\t", 1)[0], at, len(block)])
            out.write(block)
            at, lines = at + len(block), []

        for b in batches:
            for key, page_id, file, offset, length in zip(*(b.column(c).to_pylist() for c in
                                                            ("surt", "page_id", "file", "offset", "length"))):
                if out is None:
                    out, first = store.open_output_stream(name, compression=None), key
                last = key
                lines.append(f"{key}\t{'' if page_id is None else page_id}\t{file}\t{offset}\t{length}\n")
                if len(lines) >= block_lines:
                    flush()
        if out is not None:
            if lines:
                flush()
            tail = gzip.compress(json.dumps(directory).encode(), 6, mtime=0)
            out.write(tail + struct.pack(">Q", len(tail)))
            out.close()
            yield {"first_key": [first], "last_key": [last], "file": [name]}

    parts = map_arrow(manifest.repartitionByRange(*order).sortWithinPartitions(*order), write,
                      "first_key string, last_key string, file string")
    # one row for each partition of the sort
    rows = sorted(materialize(parts, "warc-parts").collect(), key=lambda r: (r.first_key, r.last_key))
    return CaptureIndex(folder, tuple(r.first_key for r in rows), tuple(r.last_key for r in rows),
                        tuple(r.file for r in rows))


def _directory(handle) -> list:
    size = handle.size()
    handle.seek(size - 8)
    n = struct.unpack(">Q", handle.read(8))[0]
    handle.seek(size - 8 - n)
    return json.loads(gzip.decompress(handle.read(n)))


def lookup(index: CaptureIndex, keys: DataFrame) -> DataFrame:
    """All captures ``(surt, page_id, file, offset, length)`` of the distinct keys in ``surt``."""
    def parts_of(batches):
        for b in batches:
            out = {"surt": [], "part": []}
            for key in b.column(0).to_pylist():
                lo = bisect.bisect_left(index.last_keys, key)
                hi = bisect.bisect_right(index.first_keys, key)
                for part in range(lo, hi):
                    out["surt"].append(key)
                    out["part"].append(part)
            yield out

    def search(batches):
        store, _ = fs.FileSystem.from_uri(index.folder)
        part, handle, directory, firsts, block_no, lines, line_keys = None, None, None, None, None, None, None
        for b in batches:
            out = {k: [] for k in ("surt", "page_id", "file", "offset", "length")}
            for key, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if p != part:
                    if handle is not None:
                        handle.close()
                    part, block_no, handle = p, None, store.open_input_file(index.files[p])
                    directory = _directory(handle)
                    firsts = [d[0] for d in directory]
                at = max(0, bisect.bisect_left(firsts, key) - 1)
                while at < len(directory) and firsts[at] <= key:
                    if at != block_no:
                        handle.seek(directory[at][1])
                        text = gzip.decompress(handle.read(directory[at][2])).decode()
                        lines = [x.split("\t") for x in text.split("\n")[:-1]]
                        line_keys, block_no = [x[0] for x in lines], at
                    lo, hi = bisect.bisect_left(line_keys, key), bisect.bisect_right(line_keys, key)
                    for x in lines[lo:hi]:
                        out["surt"].append(key)
                        out["page_id"].append(int(x[1]) if x[1] else None)
                        out["file"].append(x[2])
                        out["offset"].append(int(x[3]))
                        out["length"].append(int(x[4]))
                    if len(out["surt"]) >= 20_000:
                        yield out
                        out = {k: [] for k in out}
                    at += 1
            yield out
        if handle is not None:
            handle.close()

    assigned = map_arrow(keys.select("surt").where("surt is not null").distinct(), parts_of, "surt string, part int")
    return map_arrow(assigned.repartition("part").sortWithinPartitions("part", "surt"), search, MANIFEST)


def read_records(captures: DataFrame, folder: str, span: int = READ_SPAN) -> DataFrame:
    """Range-read the captured records: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    The digest of a response is computed from the payload read and must agree
    with its header; a revisit's are those of the payload it stands for.
    """
    near = F.floor(F.col("offset") / span)
    in_order = captures.repartition(F.col("file"), near).sortWithinPartitions("file", "offset")

    def read(batches):
        store, _ = fs.FileSystem.from_uri(folder)
        name, handle = None, None
        for b in batches:
            out = {k: [] for k in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")}
            for file, offset, length in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if file != name:
                    if handle is not None:
                        handle.close()
                    name, handle = file, store.open_input_file(file)
                handle.seek(offset)
                headers, payload = parse_record(gzip.decompress(handle.read(length)))
                digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                kind = headers["WARC-Type"]
                if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"payload digest differs at {file}:{offset}")
                out["page_id"].append(_page_id(headers["WARC-Record-ID"]))
                out["payload_bytes"].append(len(payload) if kind == "response" else int(headers["X-Payload-Length"]))
                out["payload_digest"].append(digest)
                out["record_type"].append(kind)
                out["refers_to"].append(_page_id(headers["WARC-Refers-To"]) if kind == "revisit" else None)
            yield out
        if handle is not None:
            handle.close()

    return map_arrow(in_order, read, "page_id bigint, payload_bytes bigint, payload_digest string, "
                     "record_type string, refers_to bigint")


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write all pages, index them, look every key up and read its records back."""
    folder = scratch_path(pages.sparkSession, "llm-warc")
    manifest = write_archives(classify(pages), folder)
    index = build_index(manifest, f"{folder}/index")
    return read_records(lookup(index, manifest.select("surt")), folder)
