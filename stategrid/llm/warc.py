"""Legacy archives (ARC) and their conversion to WARC, as Spark jobs.

An archive is a gzip or plain file of records. ``read_arc`` parses the
version-specific header lines (5 fields in version 1, 10 in version 2, the
last one the declared length) and, from each record, synthesises what a WARC
record needs: an identifier (UUID 5 of archive name, offset, URL, date and
block digest, so a rerun gives the same one), a timestamp (from the 8 to 14
digits of the legacy date), a type (warcinfo for the version block, response
for HTTP replies, else resource) and SHA-1 digests of block and payload in
base 32. ``revisits`` finds records whose payload another response has,
``write_warc`` writes the records - a revisit with its HTTP header only - and
``read_warc`` reads archives back and checks every digest.

Files are written by Spark's own writer (one per task, committed with the
task), so a lost executor leaves no half archive, and are as large as a scan
partition (``spark.sql.files.maxPartitionBytes``). A file is read in one task
as a stream: memory holds the compressed file and one record.

Rules: null html is empty; a null page_id gives a record without one. Of equal
payloads (same digest and length) the smallest page_id is the response, null
ids last, ties to the smaller identifier. Blanks and control characters of a
URL are percent-encoded; one without a scheme gets ``page:`` before it (and the
id, if null or empty). A record cut short by the end of its file is kept and marked truncated; lines
that are no header of the archive's version are skipped up to the next header,
and reported (type ``problem``, with their bytes). An empty table gives no
archive and an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stategrid.session import materialize

#: Field names of the header lines of both versions.
FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length".split(),
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset "
         "Filename Archive-length".split(),
}
#: Fixed value: the profile of revisits that drop an equal payload.
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
SCHEME = r"[A-Za-z][A-Za-z0-9+.-]*:"
ARC_END, WARC_END = "\n", "\r\n\r\n"
BATCH_BYTES = 4 << 20

RECORD = ("record_id string, type string, uri string, date string, ip string, content_type string, "
          "page_id long, block_digest string, payload_digest string, payload_bytes long, "
          "truncated boolean, block binary")
READ = ("record_id string, type string, uri string, date string, page_id long, "
        "payload_digest string, payload_bytes long, refers_to string, intact boolean")


def sha1_32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _rows(records, schema: str):
    """Data frames of about BATCH_BYTES from an iterator of tuples."""
    names = [c.split()[0] for c in schema.split(", ")]
    rows, size = [], 0

    def frame():
        out = pd.DataFrame(rows, columns=names)
        return out.astype({c: "Int64" for c in ("page_id", "payload_bytes") if c in names})

    for r in records:
        rows.append(r)
        size += 200 + (len(r[-1]) if isinstance(r[-1], bytes) else 0)
        if size >= BATCH_BYTES:
            yield frame()
            rows, size = [], 0
    if rows:
        yield frame()


# --- legacy archives

def arc_header(version: str, uri: str, ip: str, date: str, kind: str, length: int, code: str,
               checksum: str, offset: int, name: str) -> bytes:
    extra = [] if version == "1" else [code, checksum, "-", str(offset), name]
    return " ".join([uri, ip, date, kind, *extra, str(length)]).encode()


def http_reply(page_id, html: bytes) -> bytes:
    own = b"" if page_id is None else b"X-Page-Id: %d\r\n" % page_id
    return (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + own
            + b"Content-Length: %d\r\n\r\n" % len(html) + html)


def arc_rows(pages: DataFrame, version: str, date: str = "20200101000000") -> DataFrame:
    """The records of ``pages`` (page_id, url, html) in a legacy version, a
    partition an archive that starts with its version block."""
    def build(batches):
        name = f"pages-v{version}-{TaskContext.get().partitionId():06d}.arc"
        at, kind = 0, "text/plain"

        def row(uri, ip, kind, body, code):
            nonlocal at
            out = arc_header(version, uri, ip, date, kind, len(body), code,
                             hashlib.md5(body).hexdigest(), at, name) + b"\n" + body
            at += len(out) + len(ARC_END)
            return out

        for b in batches:
            out = []
            if not at:
                about = f"{version} 0 stategrid\n{' '.join(FIELDS[version])}\n".encode()
                out.append(row(f"filedesc://{name}", "0.0.0.0", kind, about, "200"))
            for page_id, url, html in zip(b["page_id"], b["url"], b["html"]):
                i = None if pd.isna(page_id) else int(page_id)
                uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
                if not re.match(SCHEME, uri):
                    uri = f"page:{uri or ('' if i is None else i)}"
                out.append(row(uri, "0.0.0.0", "text/html",
                               http_reply(i, (html or "").encode()), "200"))
            yield pd.DataFrame({"value": out})

    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"),
                          F.col("url").cast("string").alias("url"),
                          F.col("html").cast("string").alias("html"))
    return narrow.mapInPandas(build, "value binary")


def write_archives(rows: DataFrame, path: str, end: str) -> None:
    """Binary rows as gzip files under ``path``, each followed by ``end``. A
    cast to string keeps the bytes, and the text writer writes them raw."""
    rows.select(F.col("value").cast("string").alias("value")).write.option(
        "lineSep", end).option("compression", "gzip").option(
        "zlib.compress.level", "BEST_SPEED").text(path)


def _open(content: bytes):
    return gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" \
        else io.BytesIO(content)


def _fields(line: bytes, version: str) -> list[str] | None:
    """The fields of a header line; the URL may hold blanks."""
    f = line.decode("utf-8", "replace").rstrip("\r\n").rsplit(" ", len(FIELDS[version]) - 1)
    good = (len(f) == len(FIELDS[version]) and f[-1].isdecimal() and f[2].isdecimal()
            and 8 <= len(f[2]) <= 14 and re.match(SCHEME, f[0]))
    return f if good else None


def parse_arc(content: bytes):
    """(offset, fields, block, truncated) of each record of an archive, the
    version block first; (offset, None, bytes, False) for skipped lines."""
    data = _open(content)
    first = data.readline()
    at, declared = 0, first.rstrip().rsplit(b" ", 1)[-1]
    about = data.read(int(declared)) if declared.isdigit() else b""
    version = about[:1].decode("latin-1")
    if version not in FIELDS or not first.startswith(b"filedesc:"):
        yield 0, None, first + about + data.read(), False
        return
    yield 0, _fields(first, version) or _fields(first, "1"), about, len(about) < int(declared)
    at, skipped, since = len(first) + len(about), b"", 0
    while line := data.readline():
        fields = _fields(line, version)
        if fields:
            if skipped:
                yield since, None, skipped, False
            skipped, length = b"", int(fields[-1])
            block = data.read(length)
            yield at, fields, block, len(block) < length
            at += len(block)
        elif line.strip() or skipped:           # blank lines part the records
            since, skipped = (since if skipped else at), skipped + line
        at += len(line)
    if skipped:
        yield since, None, skipped, False


def warc_date(digits: str) -> str:
    d = digits[:14] + "00000101000000"[len(digits):14]
    out = f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"
    try:
        pd.Timestamp(out)
    except ValueError:
        return "1970-01-01T00:00:00Z"
    return out


def _payload(block: bytes) -> tuple[bytes, bytes]:
    """HTTP header (with its empty line) and payload of a reply."""
    head, gap, body = block.partition(b"\r\n\r\n")
    return (head + gap, body) if gap else (block, b"")


def _page_id(head: bytes) -> int | None:
    found = re.search(rb"(?mi)^X-Page-Id: (-?\d+)\r?$", head)
    return int(found[1]) if found else None


def synthesise(archive: str, offset: int, fields: list[str], block: bytes, truncated: bool) -> tuple:
    """The WARC record (columns RECORD) of one legacy record."""
    uri, ip, date, kind = fields[:4]
    page_id, body = None, block
    if uri.startswith("filedesc:"):
        type_, kind = "warcinfo", "text/plain"
    elif block.startswith(b"HTTP/"):
        head, body = _payload(block)
        type_, kind, page_id = "response", "application/http; msgtype=response", _page_id(head)
    else:
        type_ = "resource"
    digest, date = sha1_32(block), warc_date(date)
    name = "\n".join([archive, str(offset), uri, date, digest])
    return (f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}", type_, uri, date, ip, kind,
            page_id, digest, sha1_32(body), len(body), truncated, block)


def read_arc(spark: SparkSession, paths: list[str], blocks: bool = True) -> DataFrame:
    """The WARC records (columns RECORD) of legacy archives, ``block`` null if
    not asked for; skipped bytes have the type ``problem``."""
    def convert(batches):
        def records():
            for b in batches:
                for content in b["content"]:
                    archive = ""
                    for at, fields, block, cut in parse_arc(content):
                        if fields is None:
                            yield (None, "problem", archive, None, None, None, None, None,
                                   None, len(block), False, block if blocks else None)
                            continue
                        archive = fields[0] if not at else archive
                        r = synthesise(archive, at, fields, block, cut)
                        yield r if blocks else r[:-1] + (None,)
        yield from _rows(records(), RECORD)

    files = spark.read.format("binaryFile").load(paths)
    return files.select("content").mapInPandas(convert, RECORD)


# --- equal payloads

def revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(revisit_id, refers_to): responses whose payload of at least
    ``min_bytes`` the first of its kind has. ``records`` should be a
    written table without blocks. The groups' first records are written, so
    that the join's sides are plain shuffles and a payload that many records
    share is split over tasks (adaptive skew join)."""
    own = records.where((F.col("type") == "response") & (F.col("payload_bytes") >= min_bytes))
    first = own.groupBy("payload_digest", "payload_bytes").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id"))
        .alias("f"), F.count("*").alias("n")).where("n > 1")
    first = materialize(first.select(
        F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("n"),
        F.col("f.record_id").alias("refers_to")), "first-payloads")
    return own.join(first, (F.col("payload_digest") == F.col("d"))
                    & (F.col("payload_bytes") == F.col("n"))).where(
        F.col("record_id") != F.col("refers_to")).select(
        F.col("record_id").alias("revisit_id"), "refers_to")


# --- WARC

def warc_rows(records: DataFrame, again: DataFrame) -> DataFrame:
    """The bytes of each record but its end mark; ``again`` as ``revisits``."""
    def build(batches):
        def rows():
            for b in batches:
                for r in b.itertuples(index=False):
                    block, type_, lines = r.block, r.type, []
                    if isinstance(r.refers_to, str):
                        block, type_ = _payload(r.block)[0], "revisit"
                        lines = [f"WARC-Refers-To: <{r.refers_to}>", f"WARC-Profile: {PROFILE}"]
                    lines = [f"WARC-Type: {type_}", f"WARC-Record-ID: <{r.record_id}>",
                             f"WARC-Date: {r.date}", *lines]
                    if type_ == "warcinfo":
                        lines.append(f"WARC-Filename: {r.uri.removeprefix('filedesc://')}")
                    else:
                        lines += [f"WARC-Target-URI: {r.uri}", f"WARC-IP-Address: {r.ip}"]
                    lines += [f"WARC-Payload-Digest: sha1:{r.payload_digest}",
                              f"WARC-Block-Digest: sha1:{sha1_32(block)}",
                              f"Content-Type: {r.content_type}", f"Content-Length: {len(block)}"]
                    if r.truncated:
                        lines.append("WARC-Truncated: unspecified")
                    yield ("\r\n".join(["WARC/1.0", *lines, "", ""]).encode() + block,)
        yield from _rows(rows(), "value binary")

    whole = records.where(F.col("type") != "problem").join(
        again, F.col("record_id") == F.col("revisit_id"), "left")
    return whole.select("record_id", "type", "uri", "date", "ip", "content_type",
                        "payload_digest", "truncated", "refers_to", "block").mapInPandas(
        build, "value binary")


def parse_warc(content: bytes):
    """(headers, block) of each record; header names in lower case."""
    data = _open(content)
    while line := data.readline():
        if not line.startswith(b"WARC/"):
            if line.strip():
                raise ValueError(f"no WARC record where one should start: {line[:60]!r}")
            continue
        headers = {}
        while (line := data.readline()).strip():
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        yield headers, data.read(int(headers["content-length"]))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records (columns READ) of WARC files. ``payload_digest`` is that of
    the payload read, for a revisit that of its header, whose payload and
    length are not in the file; ``intact``: what was read has its digests."""
    def parse(batches):
        def records():
            for b in batches:
                for content in b["content"]:
                    for h, block in parse_warc(content):
                        said = h["warc-payload-digest"].removeprefix("sha1:")
                        http = h["content-type"].startswith("application/http")
                        head, body = _payload(block) if http else (b"", block)
                        revisit = h["warc-type"] == "revisit"
                        digest = said if revisit else sha1_32(body)
                        yield (h["warc-record-id"].strip("<>"), h["warc-type"],
                               h.get("warc-target-uri"), h["warc-date"], _page_id(head), digest,
                               None if revisit else len(body),
                               h["warc-refers-to"].strip("<>") if revisit else None,
                               digest == said
                               and sha1_32(block) == h["warc-block-digest"].removeprefix("sha1:"))
        yield from _rows(records(), READ)

    files = spark.read.format("binaryFile").load(path)
    return files.select("content").mapInPandas(parse, READ)


def resolve(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the
    responses and revisits of ``read_warc`` (a written table): a revisit's
    length and refers_to are those of the response it names."""
    was = records.where("type = 'response'").select(
        F.col("record_id").alias("_at"), F.col("page_id").alias("_page"),
        F.col("payload_bytes").alias("_bytes"))
    own = records.where("type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"))
    again = records.where("type = 'revisit'").join(was, F.col("refers_to") == F.col("_at"), "left")
    return own.unionByName(again.select(
        "page_id", F.col("_bytes").alias("payload_bytes"), "payload_digest",
        F.col("type").alias("record_type"), F.col("_page").alias("refers_to")))


def convert(spark: SparkSession, arcs: list[str], path: str, min_bytes: int = 0) -> None:
    """Legacy archives to WARC files under ``path``. The archives are read
    twice: without blocks to find equal payloads, then to write."""
    narrow = materialize(read_arc(spark, arcs, blocks=False).select(
        "record_id", "type", "page_id", "payload_digest", "payload_bytes"), "arc-records")
    again = materialize(revisits(narrow, min_bytes), "revisits")
    write_archives(warc_rows(read_arc(spark, arcs), again), path, WARC_END)
