"""WARC archives of pages: written as whole-file gzip streams, normalised, read back by offset.

A crawler often leaves archives that are one gzip stream each: nothing inside can be read
without inflating everything before it.  ``normalise`` inflates every such stream once, in
bounded memory, writes each record as a gzip member of its own and an index of (offset, length,
record) beside the archive.  ``read_records`` then reads any records by seeking, in splits that
follow the index and not the files.

Tasks read and write archives through ``pyarrow.fs`` in a folder under ``spark.checkpoint.dir``.
Every attempt of a task writes files of its own name; only the rows of the attempt that Spark
accepts name them, so a lost executor leaves at most files that nothing refers to.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import materialize, numbered
from larder.plans.materialize import new_folder
from larder.plans.materialize import opened as _open

#: Payloads shorter than this are stored in full however often they occur.
MIN_REVISIT_BYTES = 1000
#: Bytes read, inflated and passed on at a time.
CHUNK = 1 << 20
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
HTTP = "application/http; msgtype=response"
#: Longest record header that is accepted.
MAX_HEADER = 1 << 20


def _uri(text: str) -> str:
    """A header value: control characters, blanks and non-ASCII as percent codes."""
    return "".join(c if "\x21" <= c <= "\x7e" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in text)


def _http(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record; the header Content-Length is added."""
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers), f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _record_id(key: int) -> str:
    return f"<urn:uuid:{uuid.UUID(int=(0x1A2DE2 << 104) | (key & ((1 << 64) - 1)))}>"


def planned_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(rid, page_id, url, payload, sha1, first): one row per page; first is the rid of the response it repeats.

    Of pages with equal payloads of at least ``min_bytes`` the one of the largest page_id (of
    repeated ids and of nulls the first row) is the response; first is null for responses.
    Payload is the html as UTF-8, empty where it is null.
    """
    rows = numbered(pages, "page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("key", F.when(F.length("payload") >= min_bytes, F.sha2("payload", 256)))
    last = F.max(F.struct("page_id", (-F.col("rid")).alias("r")))
    groups = (rows.select("key", "page_id", "rid").where(F.col("key").isNotNull()).groupBy("key")
              .agg(last.alias("m"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("key").alias("k"), (-F.col("m.r")).alias("lead")))
    joined = rows.join(materialize(groups, "payload-groups"), F.col("key") == F.col("k"), "left")
    return joined.select("rid", "page_id", "url", "payload", F.sha1("payload").alias("sha1"),
                         F.when(F.col("lead") != F.col("rid"), F.col("lead")).alias("first"))


def write_archives(records: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """(archive, n_records, n_bytes): the rows of ``planned_records`` written as WARC files, a gzip stream each.

    Every partition is one file.  Revisits have the HTTP header, no payload, and refer to
    their response's record.
    """
    def run(batches):
        import zlib

        import pyarrow as pa

        store = out = None
        n = size = 0
        name = f"pages-{uuid.uuid4().hex}.warc.gz"
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                store, path = _open(folder)
                out, gz = store.open_output_stream(f"{path}/{name}", compression=None), zlib.compressobj(level, zlib.DEFLATED, 31)
            for start in range(0, b.num_rows, 64):
                for r in b.slice(start, 64).to_pylist():
                    revisit = r["first"] is not None
                    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(r["rid"])), ("WARC-Date", DATE)]
                    if r["url"] is not None:
                        head.append(("WARC-Target-URI", _uri(r["url"])))
                    if r["page_id"] is not None:
                        head.append(("Page-ID", quote(str(r["page_id"]), safe="")))
                    head += [("WARC-Payload-Digest", f"sha1:{r['sha1']}"), ("Content-Type", HTTP)]
                    if revisit:
                        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(r["first"]))]
                    data = gz.compress(record(head, _http(len(r["payload"])) + (b"" if revisit else r["payload"])))
                    size, n = size + len(data), n + 1
                    out.write(data)
        if out is not None:
            data = gz.flush()
            out.write(data)
            out.close()
            yield pa.record_batch([pa.array([f"{folder}/{name}"]), pa.array([n], pa.int64()), pa.array([size + len(data)], pa.int64())],
                                  names=["archive", "n_records", "n_bytes"])

    return materialize(records.mapInArrow(run, "archive string, n_records long, n_bytes long"), "archives")


def _inflated(stream):
    """The bytes of a gzip file of one or more members, a chunk at a time."""
    import zlib

    gz, started, data = zlib.decompressobj(31), False, stream.read(CHUNK)
    while data:
        started = True
        part = gz.decompress(data, CHUNK)
        if part:
            yield part
        data = gz.unconsumed_tail
        if gz.eof:
            data, gz, started = gz.unused_data, zlib.decompressobj(31), False
        data = data or stream.read(CHUNK)
    while started and not gz.eof:  # what the last chunk still holds
        part = gz.decompress(gz.unconsumed_tail, CHUNK)
        if not part:
            raise ValueError("the gzip stream ends before its time")
        yield part


class _Pieces:
    """Reads headers and counted bytes from an iterator of byte chunks; what is read is passed over, not cut off."""

    def __init__(self, chunks):
        self.chunks, self.held, self.at = chunks, b"", 0

    def more(self) -> bool:
        part = next(self.chunks, b"")
        if part:
            self.held, self.at = self.held[self.at:] + part, 0
        return bool(part)

    def until(self, mark: bytes) -> bytes | None:
        """The bytes up to and with ``mark``; None at the end of the stream."""
        seen = 0
        while (found := self.held.find(mark, self.at + seen)) < 0:
            seen = max(0, len(self.held) - self.at - len(mark) + 1)
            if seen > MAX_HEADER:
                raise ValueError("a record header has no end")
            if not self.more():
                if self.held[self.at:].strip():
                    raise ValueError("the archive ends inside a record header")
                return None
        start, self.at = self.at, found + len(mark)
        return self.held[start:self.at]

    def take(self, n: int):
        """The next ``n`` bytes, in pieces."""
        while n:
            if self.at == len(self.held) and not self.more():
                raise ValueError("the archive ends inside a record")
            part = self.held[self.at:self.at + n]
            self.at += len(part)
            n -= len(part)
            yield part


def parse_header(raw: bytes) -> dict[str, str]:
    """Header fields by lower-case name; the first line must name a WARC version."""
    first, *lines = raw.strip().split(b"\r\n")
    if not first.startswith(b"WARC/"):
        raise ValueError(f"no WARC record begins here: {first[:40]!r}")
    fields = (line.partition(b":") for line in lines)
    return {k.strip().lower().decode(): v.strip().decode("utf-8", "replace") for k, _, v in fields}


INDEX = "archive string, offset long, length long, record_id string, record_type string, refers_to string, page string, url string, block_bytes long"


def normalise(archives: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """The index of archives rewritten with one gzip member per record.

    ``archives`` has a column ``archive`` of URIs; each is inflated once as a stream, in pieces
    of ``CHUNK`` bytes.  Beside every new archive lies its index as lines of the same columns
    (``.idx``, tab-separated).  Returned is the index of all of them, one row per record, in a
    written table.  A broken archive raises an error; an empty one has no records.
    """
    n = max(1, archives.count())

    def run(batches):
        import zlib

        import pyarrow as pa
        from pyarrow import fs

        store = None
        for b in batches:
            for uri in b.column(b.schema.get_field_index("archive")).to_pylist():
                if store is None:
                    store, path = _open(folder)
                source, at = fs.FileSystem.from_uri(uri)
                name = f"records-{uuid.uuid4().hex}.warc.gz"
                rows, offset = [], 0
                with (source.open_input_stream(at, compression=None) as stream, store.open_output_stream(f"{path}/{name}", compression=None) as out,
                      store.open_output_stream(f"{path}/{name}.idx", compression=None) as side):
                    pieces = _Pieces(_inflated(stream))
                    while (raw := pieces.until(b"\r\n\r\n")) is not None:
                        head = parse_header(raw)
                        size, length = int(head["content-length"]), 0
                        gz = zlib.compressobj(level, zlib.DEFLATED, 31)
                        raw = raw.lstrip(b"\r\n")
                        length += _put(out, gz.compress(raw))
                        for part in pieces.take(size + 4):
                            length += _put(out, gz.compress(part))
                        length += _put(out, gz.flush())
                        row = (f"{folder}/{name}", offset, length, head.get("warc-record-id"), head.get("warc-type"), head.get("warc-refers-to"),
                               unquote(head["page-id"]) if "page-id" in head else None, head.get("warc-target-uri"), size)
                        rows.append(row)
                        side.write("\t".join("" if x is None else str(x) for x in row).encode() + b"\n")
                        offset += length
                        if len(rows) == 4096:
                            yield _index(pa, rows)
                            rows = []
                if rows:
                    yield _index(pa, rows)

    return materialize(archives.select("archive").repartition(n, "archive").mapInArrow(run, INDEX), "warc-index")


def _put(out, data: bytes) -> int:
    if data:
        out.write(data)
    return len(data)


def _index(pa, rows):
    kinds = [pa.string() if f.split()[1] == "string" else pa.int64() for f in INDEX.split(", ")]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[f.split()[0] for f in INDEX.split(", ")])


RECORDS = "record_id string, record_type string, refers_to string, page string, url string, payload_bytes long, payload_digest string, declared_digest string"


def read_records(index: DataFrame, payloads: bool = False, split_bytes: int = 32 << 20) -> DataFrame:
    """The indexed records, read by seeking: one row each, with the size and SHA-1 of its own payload.

    Splits are contiguous ranges of the index of about ``split_bytes``, whatever the sizes of the
    archives.  ``payloads`` adds the payload itself.  A payload that does not have the digest that
    its record declares raises an error (a revisit declares that of its response and is not
    compared here).
    """
    spark = index.sparkSession
    total = index.agg(F.sum("length")).first()[0] or 0
    n = max(spark.sparkContext.defaultParallelism, -(-total // split_bytes))
    kind = RECORDS + (", payload binary" if payloads else "")

    def run(batches):
        import hashlib
        import zlib

        import pyarrow as pa
        from pyarrow import fs

        uri = stream = None
        names = [f.split()[0] for f in kind.split(", ")]
        types = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]] for f in kind.split(", ")]
        for b in batches:
            for start in range(0, b.num_rows, 256):
                rows = []
                for r in b.slice(start, 256).to_pylist():
                    if r["archive"] != uri:
                        if stream is not None:
                            stream.close()
                        uri = r["archive"]
                        store, at = fs.FileSystem.from_uri(uri)
                        stream = store.open_input_file(at)
                    stream.seek(r["offset"])
                    raw = zlib.decompress(stream.read(r["length"]), 31)
                    at = raw.index(b"\r\n\r\n") + 4
                    head, block = parse_header(raw[:at]), raw[at:-4]
                    payload = block.partition(b"\r\n\r\n")[2] if head.get("content-type", "").startswith("application/http") else block
                    sha1, said = hashlib.sha1(payload).hexdigest(), head.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    if head.get("warc-type") != "revisit" and said not in (None, sha1):
                        raise ValueError(f"{head.get('warc-record-id')} in {uri} does not have its digest")
                    rows.append((r["record_id"], r["record_type"], r["refers_to"], r["page"], r["url"], len(payload), sha1, said, *([payload] if payloads else [])))
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)], names=names)
        if stream is not None:
            stream.close()

    dealt = index.repartitionByRange(n, "archive", "offset").sortWithinPartitions("archive", "offset")
    return dealt.mapInArrow(run, kind)


def archived_pages(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): the pages as read back from their archives.

    One row per row of ``pages`` (page_id, url, html; further columns are not read).  A null html
    is an empty payload, a null url gives no target, a null page_id comes back null; repeated rows
    are records of their own.  Size and digest of a revisit are those of the response it refers
    to.  An empty table gives no archive and no rows.
    """
    spark = pages.sparkSession
    kind = pages.schema["page_id"].dataType.simpleString()
    whole = write_archives(planned_records(pages, min_bytes), new_folder(spark, "warc-streams"))
    index = normalise(whole, new_folder(spark, "warc-records"))
    records = materialize(read_records(index).withColumn("page_id", F.col("page").cast(kind)), "warc-records-read")
    own = records.where("refers_to is null").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast(kind).alias("refers_to"))
    first = records.select(F.col("record_id").alias("id"), F.col("payload_bytes").alias("size"), F.col("payload_digest").alias("digest"), F.col("page_id").alias("first"))
    again = records.where("refers_to is not null").join(first, F.col("refers_to") == F.col("id"))
    same = F.when(F.col("digest") == F.col("declared_digest"), F.col("digest"))
    again = again.select("page_id", F.col("size").alias("payload_bytes"), same.alias("payload_digest"), "record_type", F.col("first").alias("refers_to"))
    return own.union(again)
