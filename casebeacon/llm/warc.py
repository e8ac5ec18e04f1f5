"""WARC archives: writing with deduplicated payloads, and a reader that salvages damaged files.

Writing: one task writes the records of its rows to files of its own, each record a gzip member, and rolls
to a new file at ``roll_bytes``. File names are unique per attempt, and only the files named in the
manifest (a table that Spark commits) count, so lost executors and repeated tasks leave no trace.

Reading: records are checked (gzip checksum, version line, lengths, block digest). After a failed
check the reader looks for the next place where a valid member or version line begins, goes on from
there, also inside a member, and reports the bytes in between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebeacon.llm.tables import stored

ROLL_BYTES = 64_000_000
STEP = 1 << 20
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
MAGIC = b"\x1f\x8b\x08"
PIECE = 1 << 16  # compressed bytes that are inflated at a time
NO_HEADER = re.compile(rb"\r\n[^:\r\n]+\r\n")  # a line without colon
NO_START = "no member or version line"

RECORD = "file string, offset long, length long, record_type string, target_uri string, record_id string, refers_to string, payload_bytes long, payload_digest string, payload binary"
GAP = "file string, gap_start long, gap_end long, reason string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _file_system(path: str):
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def with_roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, refers_to: the page whose response this one repeats, null for responses.

    Among pages with equal payloads of at least ``min_bytes`` the smallest page_id is the response;
    repeated rows of that page are responses too, and so is a page without id where no page of its
    payload has one. Null payloads are empty ones. Only the first ids of repeated payloads are joined
    back, as a written table, so a payload on a third of all pages is a side that Spark can split.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    long_enough = F.octet_length("html") >= min_bytes
    firsts = rows.filter(long_enough).groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    firsts = stored(firsts, "warc-firsts")
    joined = rows.join(firsts, "sha", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return joined.select("page_id", "url", "html", refers.alias("refers_to"))


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def _uri(value) -> str:
    return re.sub(r"[\x00-\x20]+", "%20", value) if isinstance(value, str) else ""


def record_bytes(page_id, url, html: str, refers_to) -> bytes:
    """The record of a page; a revisit keeps the HTTP headers, with the full length, and no payload."""
    payload = html.encode()
    known = None if pd.isna(page_id) else int(page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = not pd.isna(refers_to)
    block = http if revisit else http + payload
    name = f"<urn:page:{known}>" if known is not None else f"<urn:uuid:{uuid.uuid4()}>"
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", name),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", _uri(url)),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        headers[4:4] = [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:page:{int(refers_to)}>"),
        ]
    return _member(headers, block)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes one record per page below ``folder`` and returns the manifest (file, n_records, n_bytes).

    A null html is an empty payload, a null url an empty one; repeated rows and null ids get records of their own;
    an empty table writes no file.
    """
    rows = with_roles(pages, min_bytes)

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = _file_system(folder)
        system.create_dir(f"{base}/data", recursive=True)
        out, name, records, size = None, "", 0, 0
        for frame in frames:
            for row in frame.itertuples(index=False):
                if out is None:
                    name, records, size = f"data/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                data = record_bytes(row.page_id, row.url, row.html, row.refers_to)
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= roll_bytes:
                    out.close()
                    out = None
                    yield pd.DataFrame([(name, records, size)], columns=["file", "n_records", "n_bytes"])
        if out is not None:
            out.close()
            yield pd.DataFrame([(name, records, size)], columns=["file", "n_records", "n_bytes"])

    # Ids beyond 2 ** 53 would lose digits as floats beside nulls, so they travel as nullable integers.
    written = rows.select("page_id", "url", "html", "refers_to").mapInArrow(_as_pandas(write), "file string, n_records long, n_bytes long")
    return stored(written, "warc-manifest")


def _as_pandas(work):
    """Arrow batches as frames with nullable integers, and back."""

    def run(batches):
        import pyarrow as pa

        frames = (b.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get) for b in batches)
        for frame in work(frames):
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    return run


@dataclass
class Salvage:
    """Reads one archive from a stream, holding one record and a little look-ahead at a time.

    A gzip member may hold any number of records. Its last record counts once the member's checksum holds;
    those before it count as soon as the next one has begun, so damage costs the record that it hits.
    ``plain`` reads the inside of a member, where no further members are looked for.
    """

    stream: io.RawIOBase
    name: str
    plain: bool = False
    gaps: list[tuple[str, int, int, str]] = field(default_factory=list)
    held: bytes = b""
    at: int = 0  # file offset of held[0]
    ended: bool = False
    bad: tuple[int, str] | None = None  # where the open gap began, and why

    def fill(self, size: int) -> bool:
        parts, have = [self.held], len(self.held)
        while have < size and not self.ended:
            more = self.stream.read(max(STEP, size - have))
            self.ended = not more
            parts.append(more)
            have += len(more)
        if len(parts) > 1:
            self.held = b"".join(parts)
        return have >= size

    def _drop(self, size: int) -> None:
        self.held = self.held[size:]
        self.at += size

    def _close_gap(self, end: int) -> None:
        if self.bad:
            self.gaps.append((self.name, self.bad[0], end, self.bad[1]))
            self.bad = None

    def _skip(self, why: str) -> None:
        self.bad = self.bad or (self.at, why)
        self._drop(self._next_start())

    def records(self) -> Iterator[tuple]:
        """(file, offset, length, *fields); records that share a member have its offset and no length."""
        while self.fill(1):
            self.fill(16)
            if not self.plain and self.held.startswith(MAGIC):
                yield from self._member()
                continue
            row, size, why = self._parse_plain()
            if why:
                self._skip(why)
                continue
            if row is not None:
                self._close_gap(self.at)
                yield (self.name, self.at, size, *row)
            self._drop(size)
        self._close_gap(self.at)

    def _next_start(self) -> int:
        """Bytes up to the next possible beginning of a member or record after the current byte."""
        starts = (b"WARC/1.",) if self.plain else (MAGIC, b"WARC/1.")
        while True:
            self.fill(STEP)
            found = [i for i in (self.held.find(s, 1) for s in starts) if i > 0]
            if found:
                return min(found)
            if self.ended:
                return len(self.held)
            self._drop(len(self.held) - 8)

    def _member(self) -> Iterator[tuple]:
        begin, inflated = self.at, Inflated(self)
        inside = Salvage(inflated, self.name, plain=True)
        last, several, after = None, False, 0
        for _, offset, size, *row in inside.records():
            if last is not None:
                several = True
                self._close_gap(begin)
                yield (self.name, begin, None, *last)
                # Should the member fail further on, the search goes on from the last record that was read.
                self._drop(inflated.place(offset) - self.at)
            last, after = row, offset + size
        if not inflated.unpack.eof:
            if last is not None and any(at == after and why != NO_START for _, at, _, why in inside.gaps):
                self._close_gap(begin)
                yield (self.name, begin, None, *last)
                self._drop(inflated.place(after) - self.at)
            self._skip(inflated.why)
            return
        end = inflated.next
        if last is not None:
            self._close_gap(begin)
            self.gaps += [(self.name, begin, end, why) for _, _, _, why in inside.gaps[:1]]
            yield (self.name, begin, None if several else end - begin, *last)
        elif inside.gaps:
            self.bad = self.bad or (begin, inside.gaps[0][3])
        self._drop(end - self.at)

    def _parse_plain(self) -> tuple[tuple | None, int, str]:
        """(record, bytes used, "") or (None, 0, reason); (None, bytes, "") for empty lines between records."""
        if not VERSION.match(self.held):
            blank = len(self.held) - len(self.held.lstrip(b"\r\n"))
            return None, blank, "" if blank else NO_START
        while True:
            row, size, why = parse_record(self.held)
            if why != "truncated" or self.ended:
                return row, size, why
            self.fill(2 * len(self.held) + STEP)


class Inflated:
    """The contents of the gzip member at an archive's current byte, inflated piece by piece as they are read."""

    def __init__(self, archive: Salvage) -> None:
        self.archive, self.unpack, self.why = archive, zlib.decompressobj(31), ""
        self.next = archive.at  # file offset of the next byte to inflate
        self.made = 0
        self.pieces: list[tuple[int, int]] = []  # (first byte made, file offset) of every piece since the last record

    def read(self, size: int) -> bytes:
        while not self.unpack.eof and not self.why:
            at = self.next - self.archive.at
            if not self.archive.fill(at + 1):
                self.why = "truncated member"
                break
            piece = self.archive.held[at : at + PIECE]
            try:
                data = self.unpack.decompress(piece)
            except zlib.error as error:
                self.why = f"gzip: {str(error)[:80]}"
                break
            self.pieces.append((self.made, self.next))
            self.next += len(piece) - len(self.unpack.unused_data)
            self.made += len(data)
            if data:
                return data
        return b""

    def place(self, offset: int) -> int:
        """File offset of the piece that made the byte at ``offset``; earlier pieces are forgotten."""
        while len(self.pieces) > 1 and self.pieces[1][0] <= offset:
            del self.pieces[0]
        return self.pieces[0][1]


def parse_record(data: bytes) -> tuple[tuple | None, int, str]:
    """The record at the beginning of ``data``: (fields, size, "") or (None, 0, reason).

    A header may be of any length; one that has not ended yet is given up once it holds what no header holds.
    """
    if not VERSION.match(data):
        return None, 0, "no version line"
    head = data.find(b"\r\n\r\n")
    if head < 0:
        return None, 0, "no header" if NO_HEADER.search(data) else "truncated"
    fields: dict[str, str] = {}
    for line in data[:head].split(b"\r\n")[1:]:
        key, colon, value = line.partition(b":")
        if not colon:
            return None, 0, "header line without colon"
        fields[key.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not fields.get("content-length", "").isdigit():
        return None, 0, "no length"
    start, length = head + 4, int(fields["content-length"])
    block = data[start : start + length]
    if len(data) < start + length + 4:
        return None, 0, "truncated"
    if data[start + length : start + length + 4] != b"\r\n\r\n":
        return None, 0, "wrong length"
    said = fields.get("warc-block-digest", "")
    if said.startswith("sha1:") and said[5:] != digest(block):
        return None, 0, "block digest"
    kind = fields.get("warc-type", "")
    payload, size = block, length
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        told = re.search(rb"(?im)^content-length:[ \t]*(\d+)\r?$", http)
        size = int(told[1]) if kind == "revisit" and told else len(payload)
    said = fields.get("warc-payload-digest", "")
    said = said[5:] if said.startswith("sha1:") else ""
    if kind != "revisit":
        if said and said != digest(payload):
            return None, 0, "payload digest"
        said = said or digest(payload)
    row = (kind, fields.get("warc-target-uri", ""), fields.get("warc-record-id", ""), fields.get("warc-refers-to"), size, said or None, None if kind == "revisit" else payload)
    return row, start + length + 4, ""


def read_archives(files: DataFrame, folder: str = "", payloads: bool = True) -> tuple[DataFrame, DataFrame]:
    """(records, gaps) of the archives named in column ``file``, relative to ``folder`` if given.

    Each task streams whole files, one record in memory at a time, whether members hold one record or all. A missing file is an error; an empty one
    has neither records nor gaps. ``payloads=False`` leaves the payload null. Both tables
    come from one pass, written to the shared folder.
    """
    schema = f"{RECORD}, gap_start long, gap_end long, reason string"
    names = [part.split()[0] for part in schema.split(", ")]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name in frame["file"]:
                system, path = _file_system(f"{folder}/{name}" if folder else name)
                with system.open_input_stream(path, compression=None) as stream:
                    salvage, rows, size = Salvage(stream, name), [], 0
                    for record in salvage.records():
                        size += len(record[-1] or b"")
                        rows.append((*(record if payloads else (*record[:-1], None)), None, None, None))
                        if size > 4_000_000 or len(rows) >= 5_000:
                            yield pd.DataFrame(rows, columns=names, dtype=object)
                            rows, size = [], 0
                    rows += [(gap[0], *[None] * 9, *gap[1:]) for gap in salvage.gaps]
                    if rows:
                        yield pd.DataFrame(rows, columns=names, dtype=object)

    spread = files.select("file").repartition(max(1, files.sparkSession.sparkContext.defaultParallelism), F.col("file"))
    both = stored(spread.mapInPandas(read, schema), "warc-records")
    records = both.filter("gap_start is null").drop("gap_start", "gap_end", "reason")
    return records, both.filter("gap_start is not null").select("file", "gap_start", "gap_end", "reason")


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """(file) of all archives below a path, listed without reading them."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc*").load(path)
    return listed.select(F.col("path").alias("file"))
