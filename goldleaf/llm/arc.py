"""Legacy web archives: write ARC files, convert ARC to WARC, read WARC files.

The converter parses the record lines of ARC version 1 (five fields) and 2 (ten), takes as many bytes as a line
declares, and synthesises WARC/1.1 records: stable identifiers, ISO timestamps, record types, block and payload
digests. Records whose payload equals that of an earlier-ranked record become revisits of it. Archives are real files
in a shared folder: each task writes its file under a temporary name and moves it into place, so a retried task
replaces its own file; only files that a finished job reported are read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.session import scratch_path

#: Compressed bytes after which a new archive file begins; a reading task holds one such file.
FILE_BYTES = 8_000_000
#: Payloads from this size on are compared; smaller ones are cheaper to repeat.
LEAST_PAYLOAD = 100
#: The field lines of the two ARC versions and the WARC revisit profile.
FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length",
          2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A record line: a URL (which may hold raw spaces behind its scheme), an address, a date of 4 to 14 digits, what the version adds, the length.
_LINE = re.compile(rb"([A-Za-z][A-Za-z0-9+.-]*:.*?|\S+) ([0-9A-Fa-f.:]+|-) (\d{4,14}) (?:(.*) )?(\d+)$")


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def gunzip_all(data: bytes) -> bytes:
    """All members of a gzip file (a truncated last one as far as it goes), or the data as it is. Bytes between members are left out."""
    if data[:2] != b"\x1f\x8b":
        return data
    out, at, view = [], 0, memoryview(data)
    while (at := data.find(b"\x1f\x8b\x08", at)) >= 0:
        z, start = zlib.decompressobj(31), at
        try:
            while at < len(data) and not z.eof:  # in pieces, as a member's end copies what was fed beyond it
                piece = view[at:at + 16_384]
                out.append(z.decompress(piece))
                at += len(piece) - len(z.unused_data)
        except zlib.error:  # no member, or a damaged one: the next may follow anywhere
            at = start + 3
    return b"".join(out)


class _Files:
    """Writes records into archive files of about FILE_BYTES in a folder; one per task."""

    def __init__(self, folder: str, suffix: str, head):
        self.fs, self.base = pa.fs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.base, recursive=True)
        self.suffix, self.head, self.part, self.made = suffix, head, TaskContext.get().partitionId(), 0
        self.parts, self.size, self.n = [], 0, 0

    def name(self) -> str:
        return f"part-{self.part:06d}-{self.made:04d}{self.suffix}"

    def add(self, record: bytes) -> Iterator[tuple[str, int]]:
        if not self.parts:
            self.parts.append(_gzip(self.head(self.name())))
        self.parts.append(_gzip(record))
        self.size, self.n = self.size + len(self.parts[-1]), self.n + 1
        if self.size >= FILE_BYTES:
            yield self.close()

    def close(self) -> tuple[str, int]:
        name, n = self.name(), self.n
        temporary = f"{self.base}/.{name}.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(temporary, compression=None) as f:
            for p in self.parts:
                f.write(p)
        self.fs.move(temporary, f"{self.base}/{name}")
        self.parts, self.size, self.n, self.made = [], 0, 0, self.made + 1
        return name, n


def http_response(payload: bytes, headers: dict[str, str]) -> bytes:
    lines = [f"{k}: {v}" for k, v in {"Content-Type": "text/html; charset=UTF-8", "Content-Length": str(len(payload)), **headers}.items()]
    return ("HTTP/1.1 200 OK\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + payload


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP head and payload of a block; a block that is not an HTTP response is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = block.find(b"\r\n\r\n")
    return (block[:end + 4], block[end + 4:]) if end >= 0 else (block, b"")


def http_header(head: bytes, name: str) -> str | None:
    m = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*(.*?)[ \t]*\r?$", head)
    return m[1].decode("utf-8", "replace") if m else None


def arc_line(version: int, url: str, ip: str, date: str, mime: str, body: bytes, filename: str) -> bytes:
    tail = f"{len(body)}" if version == 1 else f"200 {hashlib.sha1(body).hexdigest()} - 0 {filename} {len(body)}"
    return f"{url} {ip} {date} {mime} {tail}\n".encode()


def write_arc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one ARC record per row (files of odd partitions are version 2) and return (file, n).

    The payload is the html in UTF-8 (NULL: empty). NULL urls become ``urn:page:<id>``; white space in a url is
    percent-encoded. The id travels as the HTTP header X-Page-Id (left out for NULL).
    """
    rows = pages.select(F.col(id_col).cast("string"), F.col(url_col).cast("string"), F.col(html_col).cast("string").cast("binary"))
    date = "20010101000000"

    def run(batches):
        version = 1 + TaskContext.get().partitionId() % 2

        def head(name):
            body = f"{version} 0 goldleaf\n{FIELDS[version]}\n".encode()
            return arc_line(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", body, name) + body + b"\n"

        out = _Files(folder, ".arc.gz", head)
        for batch in batches:
            done = []
            for page, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                body = http_response(html or b"", {} if page is None else {"X-Page-Id": page})
                url = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or f"urn:page:{page}")
                done += out.add(arc_line(version, url, "0.0.0.0", date, "text/html", body, out.name()) + body + b"\n")
            yield _listed(done)
        if out.parts:
            yield _listed([out.close()])

    return _reported(rows.mapInArrow(run, "file string, n long"), folder)


def _listed(done: list[tuple[str, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], names=["file", "n"])


def _reported(df: DataFrame, folder: str) -> DataFrame:
    """Run the writing job once and keep its report beside the files."""
    df.write.parquet(f"{folder}-report")
    return df.sparkSession.read.schema("file string, n long").parquet(f"{folder}-report")


def _contents(spark: SparkSession, folder: str, report: DataFrame, pattern: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return named.join(report.select("file"), "file", "left_semi")


def parse_arc(data: bytes, skipped: list[int] | None = None) -> Iterator[tuple]:
    """(place, version, url, ip, date, mime, block, complete) of each record after the file's head.

    The head names the version; without one, a line's number of fields tells it. A URL may hold raw spaces and a date may have fewer than 14
    digits. A line that is no record line (no URL, address, date and length) is skipped, up to the next that is; the sizes of lines skipped,
    but for blank ones, are appended to ``skipped``. A block that ends early is given as far as it goes, not complete.
    """
    data, at, place, version = gunzip_all(data), 0, 0, None
    while at < len(data):
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        line = data[at:end].rstrip(b"\r")
        found = _LINE.fullmatch(line)
        if not found:
            if line.strip() and skipped is not None:
                skipped.append(len(line))
            at = end + 1
            continue
        url, ip, date, middle, size = (x.decode("utf-8", "replace") for x in (found[i] or b"" for i in range(1, 6)))
        block = data[end + 1:end + 1 + int(size)]
        at = end + 1 + int(size)
        if url.startswith("filedesc:"):
            version = 2 if block[:1] == b"2" else 1
            continue
        fields = middle.split(" ")
        own = version or (2 if len(fields) >= 6 else 1)
        mime = " ".join(fields[:-5] if own == 2 else fields)
        yield place, own, url, ip, date, mime, block, len(block) == int(size)
        place += 1


def record_id(file: str, place: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{place}')}>"


def iso_date(date: str) -> str:
    """ISO form of an archive date; a shorter one means the beginning of its period."""
    date14 = date + "00010101000000"[len(date):]
    return f"{date14[:4]}-{date14[4:6]}-{date14[6:8]}T{date14[8:10]}:{date14[10:12]}:{date14[12:14]}Z"


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


def convert(spark: SparkSession, arc_folder: str, arc_report: DataFrame, warc_folder: str, rank_header: str = "X-Page-Id",
            least_payload: int = LEAST_PAYLOAD, rank_type: str = "decimal(38,0)") -> DataFrame:
    """Convert the reported ARC files to WARC files and return (file, n).

    HTTP blocks become response records, other blocks resource records. Among records of equal payloads of
    at least ``least_payload`` bytes the one with the least value of type ``rank_type`` in the HTTP header ``rank_header`` (none, or no such value: last),
    then date, file and place stays; the others become revisit records that keep their HTTP head and refer to it.
    Only digests and places are shuffled to find them, reduced before the shuffle, so thousands of copies cost one row
    per task; then each task opens the archives whose names it gets, in a folder that Arrow's file systems reach as the one it writes to. The size of what a
    file holds outside its records stands in its warcinfo record. An archive without records becomes one without records; no archives make none.
    """
    source = _contents(spark, arc_folder, arc_report, "*.arc.gz")

    def index(batches):
        for batch in batches:
            for file, content in zip(*(c.to_pylist() for c in batch.columns)):
                out = []
                for place, _, url, _, date, _, block, complete in parse_arc(content):
                    head, payload = split_http(block)
                    if complete and len(payload) >= least_payload:
                        out.append((file, place, http_header(head, rank_header), date, url, hashlib.sha256(payload).hexdigest()))
                names = ["file", "place", "rank", "date", "url", "digest"]
                types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)

    found = source.mapInArrow(index, "file string, place long, rank string, date string, url string, digest string")
    found = found.withColumn("rank", F.col("rank").try_cast(rank_type))
    path = scratch_path(spark, "arc-index")
    found.write.parquet(path)
    found = spark.read.parquet(path)
    kept = found.groupBy("digest").agg(
        F.min(F.struct(F.col("rank").isNull().alias("unranked"), "rank", "date", "file", "place", "url")).alias("r"), F.count("*").alias("c")
    ).where("c > 1").select("digest", "r.*")
    again = found.select("digest", "file", "place").join(
        kept.select("digest", F.col("file").alias("of_file"), F.col("place").alias("of_place"), F.col("date").alias("of_date"),
                    F.col("url").alias("of_url")), "digest").where("file <> of_file or place <> of_place")
    per_file = again.groupBy("file").agg(F.collect_list(F.struct("place", "of_file", "of_place", "of_date", "of_url")).alias("revisits"))

    def run(batches):
        given, inside = pa.fs.FileSystem.from_uri(arc_folder)
        for batch in batches:
            for file, revisits in zip(*(c.to_pylist() for c in batch.columns)):
                with given.open_input_stream(f"{inside}/{file}", compression=None) as f:
                    content = f.read()
                name = file.removesuffix(".arc.gz") + ".warc.gz"
                refers = {r["place"]: r for r in revisits or []}
                skipped: list[int] = []
                records = [_gzip(_warc_of(file, place, url, ip, date, mime, block, complete, refers.get(place)))
                           for place, _, url, ip, date, mime, block, complete in parse_arc(content, skipped)]
                fs, base = pa.fs.FileSystem.from_uri(warc_folder)
                fs.create_dir(base, recursive=True)
                temporary = f"{base}/.{name}.{uuid.uuid4().hex}"
                with fs.open_output_stream(temporary, compression=None) as f:
                    f.write(_gzip(_info(name, file, sum(skipped))))
                    for r in records:
                        f.write(r)
                fs.move(temporary, f"{base}/{name}")
                yield _listed([(name, len(records))])

    joined = arc_report.select("file").join(per_file, "file", "left").select("file", "revisits")
    spread = joined.repartition(max(1, min(arc_report.count(), 10_000)), "file")  # few rows, each of which is a whole file
    return _reported(spread.mapInArrow(run, "file string, n long"), warc_folder)


def _info(name: str, file: str, skipped: int = 0) -> bytes:
    body = f"software: goldleaf\r\nformat: WARC File Format 1.1\r\ndescription: converted from {file}\r\nskipped-bytes: {skipped}\r\n".encode()
    return warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(file, -1)), ("WARC-Date", "2001-01-01T00:00:00Z"),
                        ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], body)


def _warc_of(file, place, url, ip, date, mime, block, complete, refers) -> bytes:
    head, payload = split_http(block)
    kind = "revisit" if refers else "response" if head else "resource"
    headers = [("WARC-Type", kind), ("WARC-Record-ID", record_id(file, place)), ("WARC-Date", iso_date(date)), ("WARC-Target-URI", url),
               ("WARC-IP-Address", ip), ("WARC-Payload-Digest", "sha256:" + hashlib.sha256(payload).hexdigest())]
    if refers:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers["of_file"], refers["of_place"])),
                    ("WARC-Refers-To-Target-URI", refers["of_url"]), ("WARC-Refers-To-Date", iso_date(refers["of_date"]))]
        block = head
    if not complete:
        headers.append(("WARC-Truncated", "length"))
    headers += [("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()),
                ("Content-Type", "application/http;msgtype=response" if head else mime or "application/octet-stream")]
    return warc_record(headers, block)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a WARC file."""
    data, at = gunzip_all(data), 0
    while (at := data.find(b"WARC/1.", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = dict(x.split(": ", 1) for x in lines if ": " in x)
        size = int(headers["Content-Length"])
        yield headers, data[end + 4:end + 4 + size]
        at = end + 4 + size


def read_warc(spark: SparkSession, folder: str, report: DataFrame, id_header: str = "X-Page-Id") -> DataFrame:
    """One row per record but warcinfo: record_id, record_type, uri, date, id, payload_bytes, payload_digest, refers_to.

    A revisit tells the digest it declares and no payload size. A stored payload's digest is computed anew, and a record whose declared
    digest differs from it fails the read.
    """
    names = ["record_id", "record_type", "uri", "date", "id", "payload_bytes", "payload_digest", "refers_to"]

    def run(batches):
        for batch in batches:
            for file, content in zip(*(c.to_pylist() for c in batch.columns)):
                out = []
                for h, block in parse_warc(content):
                    if h["WARC-Type"] == "warcinfo":
                        continue
                    head, payload = split_http(block)
                    declared = h["WARC-Payload-Digest"].removeprefix("sha256:")
                    stored = h["WARC-Type"] != "revisit"
                    if stored and hashlib.sha256(payload).hexdigest() != declared:
                        raise ValueError(f"{file}: {h['WARC-Record-ID']} is damaged")
                    out.append((h["WARC-Record-ID"], h["WARC-Type"], h["WARC-Target-URI"], h["WARC-Date"], http_header(head, id_header),
                                len(payload) if stored else None, declared, h.get("WARC-Refers-To")))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64() if n == "payload_bytes" else pa.string())
                                                  for i, n in enumerate(names)], names=names)

    return _contents(spark, folder, report, "*.warc.gz").mapInArrow(run, ", ".join(f"{n} {'long' if n == 'payload_bytes' else 'string'}" for n in names))


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  least_payload: int = LEAST_PAYLOAD) -> DataFrame:
    """Pages to ARC files, those to WARC files, and what the WARC files hold, one row per page.

    Returns ``page_id, url, payload_bytes, payload_digest, record_type, refers_to`` (the page id of the record that a
    revisit refers to). NULL html: an empty payload. NULL url: ``urn:page:<id>``. NULL ids are written without an id, rank last
    and come back NULL. Ids are compared in their own type. Very long pages are records like any other (a task holds one archive). Repeated rows are records of their own; the first written is the response. An empty table
    makes no archive and gives no rows. Other columns are ignored.
    """
    spark = pages.sparkSession
    id_type = pages.schema[id_col].dataType.simpleString()
    arcs, warcs = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    report = write_arc(pages, arcs, id_col, url_col, html_col)
    if report.limit(1).count() == 0:
        return spark.createDataFrame([], f"page_id {id_type}, url string, payload_bytes long, payload_digest string, record_type string, refers_to {id_type}")
    back = read_warc(spark, warcs, convert(spark, arcs, report, warcs, least_payload=least_payload, rank_type=id_type))
    path = scratch_path(spark, "warc-records")
    back.write.parquet(path)
    back = spark.read.parquet(path)
    page: Column = F.col("id").cast(id_type)
    stored = back.where("record_type <> 'revisit'").select(F.col("record_id").alias("of"), page.alias("of_page"), F.col("payload_bytes").alias("of_bytes"))
    joined = back.join(stored, F.col("refers_to") == F.col("of"), "left")
    return joined.select(page.alias("page_id"), F.col("uri").alias("url"), F.coalesce("payload_bytes", "of_bytes").alias("payload_bytes"),
                         "payload_digest", "record_type", F.col("of_page").alias("refers_to"))
