"""WARC archives: written with Spark's text sink, read back with boundary-chain verification.

Reading cannot trust the record mark: payloads may hold it. Tasks emit, for each mark in a file that a header follows, the
candidate record and the offset at which its successor would begin, and which candidates follow each other without a fork
(a path). Pointer jumping from the file's start over the paths then keeps the candidates that the chain of true records
reaches; each round doubles the jump, so a chain over n paths takes log2(n) rounds.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import batched

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, release, scratch_path

VERSION = "WARC/1.1"
#: Payloads of fewer bytes are stored in full every time.
LEAST = 100
#: Records in a file, and bytes of payload in it unless one record has more: bound what a task reads at once.
RECORDS, BYTES = 4096, 1 << 28
#: Named offsets ahead that a task holds; those beyond only make more and shorter paths.
NAMED = 1_000_000
#: Bytes of an archive that are inflated at once, and that are read for it.
PIECE, BLOCK = 1 << 24, 1 << 16
MAGIC = b"\x1f\x8b"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


def classify(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST) -> DataFrame:
    """(id, url, payload, digest, n_bytes, refers_to): refers_to is null for responses.

    Pages are dealt by payload digest once; the groups' smallest ids were found before by a partial aggregation.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("n_bytes"))
    first = rows.filter(F.col("n_bytes") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    # payloads that are too short to share, all empty ones among them, are dealt by id
    match = F.when(F.col("n_bytes") >= least, F.col("digest")).otherwise(F.concat(F.lit("-"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    joined = rows.withColumn("match", match).join(first.select(F.col("digest").alias("match"), "first"), "match", "left")
    return joined.select("id", "url", "payload", "digest", "n_bytes", F.when(F.col("id") != F.col("first"), F.col("first")).alias("refers_to"))


def _uri(row_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), row_id.cast("string"), F.lit(">"))


def record(date: str = "2000-01-01T00:00:00Z") -> Column:
    """One record's text from the columns of classify(), without the blank lines that end it. Headers of null values are
    left out; control characters of a url are percent-encoded, so that no url can end a header."""
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)), F.lit(""))
    clean = F.col("url")
    for c in (0, 9, 10, 13):
        clean = F.replace(clean, F.lit(chr(c)), F.lit(f"%{c:02X}"))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"), line("Content-Length", F.col("n_bytes")), F.lit(CRLF))
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    head = [
        F.lit(f"{VERSION}{CRLF}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _uri(F.col("id"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", clean),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        line("WARC-Refers-To", _uri(F.col("refers_to"))),
        line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block)),
        F.lit(CRLF),
    ]
    return F.concat(*head, block)


def write_archives(pages: DataFrame, path: str, records: int = RECORDS, compression: str = "gzip", size: int = BYTES, **cols: str) -> None:
    """Write a record for each row of pages into files of at most `records` records and `size` bytes of payload (or one
    record of more) below path.

    Equal payloads of at least 100 bytes are stored once, with the row of the smallest id; rows of that id are responses,
    the others revisits. Null html is an empty payload. Spark's text sink counts records only, so rows are written by
    classes of length, each a doubling; equal payloads are of one class.
    """
    small = max(1, size // records)
    ratio = F.ceil(F.coalesce(F.octet_length(F.col(cols.get("html_col", "html"))), F.lit(0)) / F.lit(small))
    length = F.greatest(F.ceil(F.log2(F.greatest(ratio, F.lit(1)))), F.lit(0)).cast("int")
    found = sorted(r[0] for r in pages.select(length.alias("c")).distinct().collect())  # one a doubling
    for n, c in enumerate(found or [0]):
        part = pages.filter(length == c) if len(found) > 1 else pages
        rows = classify(part, **cols).select(record().alias("value"))
        out = rows.write.mode("append" if n else "errorifexists").option("lineSep", CRLF * 2)
        out.option("maxRecordsPerFile", max(1, records >> c)).option("compression", compression).text(path)


MARK = re.compile(rb"WARC/1\.[01]\r\n")
MARK_SIZE = len(VERSION + CRLF)
LENGTH = re.compile(rb"[0-9]{1,18}")
GAP = b"\r\n\r\n"
FIELDS = T.StructType([T.StructField(n, t) for n, t in (("file", T.StringType()), ("at", T.LongType()), ("next", T.LongType()), ("path", T.LongType()), ("type", T.StringType()), ("record_id", T.StringType()), ("refers_to", T.StringType()), ("url", T.StringType()), ("stated", T.StringType()), ("digest", T.StringType()), ("n_bytes", T.LongType()))])


def _fields(head: bytes) -> dict[bytes, bytes]:
    """The named fields of a header, its first line left out; of a repeated one the last."""
    pairs = (x.partition(b":") for x in head.split(b"\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def _length(fields: dict[bytes, bytes]) -> int | None:
    """The stated length; None if there is none, or anything but up to 18 ASCII digits."""
    value = fields.get(b"content-length", b"")
    return int(value) if LENGTH.fullmatch(value) else None


def pieces(content: bytes | memoryview) -> Iterator[bytes]:
    """The bytes of an archive in pieces of at most PIECE: a plain file as it is, of gzip all members one after the other.
    A member that is cut, or bytes other than zeros behind a member, raise."""
    view, at = memoryview(content), 0
    if bytes(view[:2]) != MAGIC:
        yield from (bytes(view[a : a + PIECE]) for a in range(0, len(view), PIECE))
        return
    while at < len(view):
        if bytes(view[at : at + 2]) != MAGIC:
            if not any(view[at:]):
                return
            raise ValueError(f"no gzip member at byte {at} of an archive")
        member = zlib.decompressobj(31)
        while not member.eof:
            block = view[at : at + BLOCK]
            out = member.decompress(block, PIECE)
            at += len(block) - len(member.unused_data or member.unconsumed_tail)
            if out:
                yield out
            elif not block and not member.eof:
                raise ValueError("the last gzip member of an archive is cut")


class _Block:
    """A record whose block comes piece by piece: the payload is what follows an HTTP header, else the whole block. It is
    hashed as it comes and not held; only an HTTP header is."""

    def __init__(self, at: int, path: int, fields: dict[bytes, bytes], body: int, end: int):
        self.at, self.path, self.fields, self.read, self.end = at, path, fields, body, end
        self.head, self.hash, self.n, self.inner = bytearray(), hashlib.sha256(), 0, {}
        self.in_head = True

    def feed(self, data: bytearray, base: int) -> bool:
        """Take what data (of the file from base on) has of the block; true when that was the last of it."""
        part = data[self.read - base : self.end - base]
        self.read += len(part)
        if self.in_head:
            seen = max(0, len(self.head) - 3)
            self.head += part
            http = self.head.startswith(b"HTTP/"[: len(self.head)])
            cut = self.head.find(GAP, seen) if http else 0
            if http and cut < 0 and self.read < self.end:
                return False
            self.in_head = False
            if http and cut >= 0:
                self.inner, part = _fields(bytes(self.head[:cut])), self.head[cut + 4 :]
            else:
                part = self.head
        self.hash.update(part)
        self.n += len(part)
        return self.read >= self.end

    def row(self) -> tuple:
        kind, record_id, refers_to, url, stated = _said(self.fields)
        revisit = kind == "revisit"
        full = _length(self.inner) if revisit else None
        return self.at, self.end + 4, self.path, kind, record_id, refers_to, url, stated, stated if revisit else self.hash.hexdigest(), self.n if full is None else full


def _said(fields: dict[bytes, bytes]) -> tuple:
    text = lambda name: fields[name].decode("utf-8", "replace") if name in fields else None
    return text(b"warc-type"), text(b"warc-record-id"), text(b"warc-refers-to"), text(b"warc-target-uri"), (text(b"warc-payload-digest") or "").removeprefix("sha256:")


def candidates(parts: Iterator[bytes]) -> Iterator[tuple]:
    """For each mark at the file's start or behind a blank line that a header with a length follows: offset, successor's
    offset, path and what the record says.

    A candidate that one candidate before it names as its successor goes on with that one's path; one that none or several
    name begins a path, which is called by its offset. Every candidate of a path leads to the next one of it.

    Payloads are hashed along the successors from the file's start, each once, as bytes come by; candidates off that line
    (their marks lie in payloads) have no digest. Nothing is held but the last bytes and a header that has not ended, so
    time and memory do not depend on how many marks payloads hold.
    """
    data, base, at = bytearray(), 0, 0  # offsets are those of the file; data begins at base; marks before `at` are done
    head: int | None = None  # offset of a mark whose header has not ended; then `at` tells how far the end was looked for
    want, block = 0, None  # where the next record begins, and the one that is being read
    named: dict[int, int] = {}  # offsets ahead that one candidate names, and its path; -1 for several
    most = NAMED
    for part in parts:
        data += part
        while True:
            if head is None:
                m = MARK.search(data, at - base)
                if not m:
                    at = max(at, base + len(data) - MARK_SIZE + 1)
                    break
                head = at = base + m.start()
                if head and data[m.start() - 4 : m.start()] != GAP:
                    head, at = None, base + m.end()
                    continue
            cut = data.find(GAP, at - base)
            if cut < 0:
                at = max(head, base + len(data) - 3)
                break
            body, fields = base + cut + 4, _fields(bytes(data[head - base : cut]))
            if (length := _length(fields)) is not None:
                if block and block.feed(data, base):
                    yield block.row()
                    want, block = block.end + 4, None
                path, after = named.pop(head, head), body + length + 4
                path = head if path < 0 else path
                if len(named) < most:
                    named[after] = -1 if after in named else path
                else:  # from here on every candidate is a path of its own
                    named, most = {}, 0
                if head == want and not block:
                    block = _Block(head, path, fields, body, body + length)
                else:
                    yield head, after, path, *_said(fields), None, None
            head, at = None, body
        if block and block.feed(data, base):
            yield block.row()
            want, block = block.end + 4, None
        first = min(head if head is not None else at - 4, at - 4, block.read if block else at)
        if first > base:
            del data[: first - base]
            base = first


def _chains(found: DataFrame) -> DataFrame:
    """(file, path) of the paths that are reached from their file's start.

    A path leads to where its last candidate does, so paths take the place of candidates: a file whose payloads hold no
    marks is one path. Each round doubles what a pointer skips; paths of files whose chain has ended are set aside."""
    steps = found.groupBy("file", "path").agg(F.max("next").alias("next")).withColumnRenamed("path", "at")
    state = keep(steps.withColumn("on", F.col("at") == 0))
    there: list[DataFrame] = []
    while True:
        jump = state.select(F.col("file").alias("f"), F.col("at").alias("a"), F.col("next").alias("n"))
        ahead = state.filter("on").select("file", F.col("next").alias("at")).distinct().withColumn("hit", F.lit(True))
        far = state.join(jump, (F.col("file") == F.col("f")) & (F.col("next") == F.col("a")), "left").select("file", "at", F.col("n").alias("next"), "on")
        before, state = state, keep(far.join(ahead, ["file", "at"], "left").select("file", "at", "next", (F.col("on") | F.coalesce("hit", F.lit(False))).alias("on")))
        if not there:
            release(before)
        open_files = state.filter("at = 0 and next is not null").select("file")
        if open_files.isEmpty():
            return reduce(DataFrame.union, [d.filter("on").select("file", F.col("at").alias("path")) for d in (*there, state)])
        ended = state.join(open_files, "file", "left_anti")
        if not ended.isEmpty():
            there.append(ended)
            state = state.join(open_files, "file", "left_semi")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row for each true record of the files below path (plain or gzip, of one or many members): file, at, next, type, record_id, refers_to,
    url, stated and digest (of the payload, by the header and by its bytes; revisits have the former), n_bytes.

    Payload: what follows the HTTP header of a block that begins with one, else the block. A chain ends where no record
    follows, so what comes after damage is not returned, nor a record that the file's end cuts. Records whose payload does
    not fit its stated digest are returned; compare the two. A gzip stream that is cut raises. A file is one task's, which
    inflates it piece by piece. A folder without files gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for some in batched(candidates(pieces(content.as_buffer())), RECORDS):
                    rows = [(name, *x) for x in some]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(zip(*rows, strict=True), ("string", *["int64"] * 3, *["string"] * 6, "int64"), strict=True)], FIELDS.names)

    files = spark.read.format("binaryFile").load(path).filter("length > 0 and not startswith(element_at(split(path, '/'), -1), '_')")
    found = keep(files.select("path", "content").mapInArrow(run, FIELDS))
    return found.join(_chains(found), ["file", "path"]).drop("path")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to) of every page, as read back from its archive.

    Rows that repeat an id are records each. A null id leaves out the record's id and reads back as null. Other columns
    are not read; an empty table gives an empty result.
    """
    spark, path = pages.sparkSession, scratch_path(pages.sparkSession)
    write_archives(pages, path, id_col=id_col, url_col=url_col, html_col=html_col)
    kind = pages.schema[id_col].dataType
    page = lambda c: F.regexp_extract(c, "^<urn:page:(.*)>$", 1).cast(kind)
    r = read_archives(spark, path)
    return r.select(page("record_id").alias(id_col), F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), page("refers_to").alias("refers_to"))


#: DuckDB SQL for round_trip() over pages.
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM q)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to FROM r"""
