"""Web archives with a two-level capture index.

Pages become WARC records (gzip members of their own) in archive files of bounded size. Of equal payloads the page with
the smallest id is kept whole and the others refer to it. The capture index has two levels: captures are sorted by their
reversed-host URL key and written as compressed blocks, many blocks to an index file; each file ends in a sparse
directory with the first key of every block, and one row per file (its first key) is the table of contents. A lookup
searches the contents, then a file's directory, then one block, each by halving, and reads the record by its range.

Scale: payloads are shuffled at most once, by their digest, and not at all where the copied digests are few enough to
be broadcast by Spark's own measure; a frequent payload is split, as the other side is a written table. Captures are
range-partitioned by (key, id, place), which has no equal rows, so a host or URL with any share of rows spreads out.
Contents hold one row per index file; their number is bounded by the tasks that wrote them and their keys by KEY_BYTES:
of a longer key the end is replaced by its digest.
Lookups are dealt by index file and then by ranges of archive files.

Lost executors: a file gets a new name with every attempt, and only the names that a committed Spark table lists are
read, so what a lost attempt left behind is never seen. Folders are given as URIs that pyarrow's file systems know
(plain paths, file, hdfs, s3, gs, abfs).

Rules: a null payload is an empty one; payloads below ``least`` bytes are never referred to; every row with the smallest id
of its payload is a response, also when repeated; a null id is larger than all others, is never referred to, and a group
of null ids alone has responses only; a null URL has the empty key and no target header; control characters in a URL are
percent-encoded in its header; empty table, empty archive; other columns are not looked at.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.llm.common import saved
from quillframe.session import scratch_path

LEAST = 100
#: Bytes of an archive file, captures of an index block, blocks of an index file, bytes of a key that contents keep.
FILE_BYTES, BLOCK_ROWS, FILE_BLOCKS, KEY_BYTES = 256 << 20, 2048, 1024, 512
#: Bytes of an archive file whose records one task reads at a time; gaps up to GAP are read rather than skipped.
STRETCH, GAP, LEVEL = 32 << 20, 1 << 16, 6
DATE = "1970-01-01T00:00:00Z"
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

CAPTURE = "key binary, page_id bigint, file string, offset bigint, length bigint"
CONTENTS = "first_key binary, first_id bigint, file string, directory_at bigint, size bigint"
RECORD = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"
_URL = re.compile(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)(.*)$", re.S)


def place(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder)


def url_key(url: str | None) -> bytes:
    """Sort key of a URL: host labels in reverse order, then path and query. ``http://a.b.org/x?y`` is ``org,b,a)/x?y``."""
    key = b"" if url is None else reversed_host(url)
    return key if len(key) <= KEY_BYTES else key[:KEY_BYTES - 64] + hashlib.sha256(key).hexdigest().encode()


def reversed_host(url: str) -> bytes:
    found = _URL.match(url)
    if not found:
        return url.encode("utf-8", "surrogatepass")
    host, rest = found.groups()
    host = host.rpartition("@")[2].lower()
    name, _, port = host.partition(":") if not host.startswith("[") else (host, "", "")
    labels = name.rstrip(".").split(".")
    if labels[0] == "www" and len(labels) > 2:
        labels = labels[1:]
    port = f":{port}" if port not in ("", "80", "443") else ""
    return f"{','.join(reversed(labels))}{port}){rest.partition('#')[0] or '/'}".encode("utf-8", "surrogatepass")


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record, uncompressed. A revisit keeps the HTTP headers, which tell the length of the whole payload."""
    revisit = refers_to is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(NAMES, f'{page_id} {url}')}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f-\x9f]", lambda m: quote(m[0]), url))
    if page_id is not None:
        lines.append(f"WARC-Page-ID: {page_id}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To-Page-ID: {refers_to}"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; the first line is left out."""
    pairs = (line.partition(":") for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def parsed(data: bytes) -> tuple:
    """page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload of a record; checks lengths and digest."""
    end = data.index(b"\r\n\r\n")
    if not data.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    head = fields(data[:end])
    block = data[end + 4:end + 4 + int(head["content-length"])]
    if data[end + 4 + len(block):] != b"\r\n\r\n" or len(block) != int(head["content-length"]):
        raise ValueError("a WARC record is cut off")
    stop = block.index(b"\r\n\r\n")
    size, digest = int(fields(block[:stop])["content-length"]), head["warc-payload-digest"].partition(":")[2]
    payload = block[stop + 4:] if head["warc-type"] == "response" else None
    if payload is not None and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("a payload differs from its digest")
    number = {k: int(head[k]) if k in head else None for k in ("warc-page-id", "warc-refers-to-page-id")}
    return number["warc-page-id"], head.get("warc-target-uri"), head["warc-type"], size, digest, number["warc-refers-to-page-id"], payload


class Writer:
    """Appends to files of bounded size in a folder; a new name for every file, so attempts never meet."""

    def __init__(self, folder: str, suffix: str, most: int = FILE_BYTES):
        self.fs, self.path = place(folder)
        self.suffix, self.most, self.out, self.name, self.at = suffix, most, None, None, 0

    def add(self, data: bytes) -> tuple[str, int]:
        """The file and the offset at which the data stand."""
        if self.out is None or self.at >= self.most:
            self.close()
            self.name, self.at = uuid.uuid4().hex + self.suffix, 0
            self.out = self.fs.open_output_stream(f"{self.path}/{self.name}", compression=None)
        offset, self.at = self.at, self.at + len(data)
        self.out.write(data)
        return self.name, offset

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def with_first(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, payload (null for revisits), size, digest, refers_to."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("bigint").alias("size"), F.sha2("payload", 256).alias("digest"))
    # Written: only payloads that occur again, one row each. The join below then splits a frequent digest, or broadcasts.
    first = saved(rows.where(F.col("size") >= least).groupBy(F.col("digest").alias("_digest")).agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                  .where("n > 1").select("_digest", "first"))
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.col("size") >= least)
    return (rows.join(first, F.col("digest") == F.col("_digest"), "left")
            .select("page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "size", "digest", F.when(again, F.col("first")).alias("refers_to")))


def write(pages: DataFrame, folder: str, least: int = LEAST, date: str = DATE) -> DataFrame:
    """Archives of the pages below ``folder``; returns the captures: key, page_id, file, offset, length."""
    place(folder)[0].create_dir(place(folder)[1], recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = Writer(folder, ".warc.gz")
        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "size", "digest", "refers_to"))):
                data = gzip.compress(record(*row, date), LEVEL, mtime=0)
                file, offset = writer.add(data)
                out.append((url_key(row[1]), row[0], file, offset, len(data)))
            yield batch_of(out, CAPTURE)
        writer.close()

    return saved(with_first(pages, least).mapInArrow(run, CAPTURE))


_TYPES = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32()}


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    columns = [c.split(" ") for c in schema.split(", ")]
    values = list(zip(*rows)) if rows else [()] * len(columns)
    return pa.RecordBatch.from_arrays([pa.array(v, _TYPES[t]) for v, (_, t) in zip(values, columns)], names=[n for n, _ in columns])


def entry(key: bytes, page_id: int | None) -> tuple[bytes, bool, int]:
    """The order of captures: key, then id, null last."""
    return key, page_id is None, page_id or 0


def index(captures: DataFrame, folder: str, rows: int = BLOCK_ROWS, blocks: int = FILE_BLOCKS) -> DataFrame:
    """Index files of the captures below ``folder``; returns the contents (CONTENTS)."""
    place(folder)[0].create_dir(place(folder)[1], recursive=True)
    order = ["key", F.col("page_id").asc_nulls_last(), "file", "offset"]
    ranged = captures.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = place(folder)
        name, out, at, directory, held = None, None, 0, [], []

        def flush():
            nonlocal name, out, at, held
            if out is None:
                name, at = uuid.uuid4().hex + ".idx", 0
                out = fs.open_output_stream(f"{path}/{name}", compression=None)
            data = zlib.compress(packed(held), LEVEL)
            directory.append([held[0][0].hex(), held[0][1], at, len(data)])
            out.write(data)
            at += len(data)
            held = []

        def finish():
            nonlocal out, directory
            tail = zlib.compress(json.dumps(directory).encode(), LEVEL)
            out.write(tail)
            out.close()
            row = bytes.fromhex(directory[0][0]), directory[0][1], name, at, len(tail)
            out, directory = None, []
            return row

        found = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "page_id", "file", "offset", "length"))):
                held.append(row)
                if len(held) == rows:
                    flush()
                    if len(directory) == blocks:
                        found.append(finish())
        if held:
            flush()
        if out is not None:
            found.append(finish())
        yield batch_of(found, CONTENTS)

    return saved(ranged.mapInArrow(run, CONTENTS))


def packed(rows: list[tuple]) -> bytes:
    """Captures of one block, each on a line."""
    return "\n".join(json.dumps([r[0].hex(), *r[1:]]) for r in rows).encode()


def unpacked(data: bytes) -> list[tuple]:
    return [(bytes.fromhex(r[0]), *r[1:]) for r in map(json.loads, data.splitlines())]


class Blocks:
    """Blocks of one index file, found by halving its directory; the last block read is kept."""

    def __init__(self, fs, path: str, directory_at: int, size: int):
        self.file = fs.open_input_file(path)
        listed = json.loads(zlib.decompress(self.file.read_at(size, directory_at)))
        self.keys = [entry(bytes.fromhex(k), i) for k, i, _, _ in listed]
        self.places = [(at, n) for _, _, at, n in listed]
        self.number, self.rows, self.order = -1, [], []

    def load(self, number: int) -> None:
        if number != self.number:
            at, size = self.places[number]
            self.number, self.rows = number, unpacked(zlib.decompress(self.file.read_at(size, at)))
            self.order = [entry(r[0], r[1]) for r in self.rows]

    def find(self, key: bytes, page_id: int | None) -> Iterator[tuple]:
        """All captures of a key and an id; they may run over several blocks."""
        want = entry(key, page_id)
        for number in range(max(0, bisect.bisect_left(self.keys, want) - 1), len(self.keys)):
            if self.keys[number] > want:
                return
            self.load(number)
            yield from self.rows[bisect.bisect_left(self.order, want):bisect.bisect_right(self.order, want)]

    def under(self, low: bytes, high: bytes | None) -> Iterator[tuple]:
        """All captures with ``low`` <= key < ``high``."""
        first = max(0, bisect.bisect_left(self.keys, (low, False, -(1 << 63))) - 1)
        for number in range(first, len(self.keys)):
            if high is not None and self.keys[number][0] >= high:
                return
            self.load(number)
            yield from (r for r in self.rows if r[0] >= low and (high is None or r[0] < high))


@dataclass
class Archive:
    """Written archives: the folder of records, that of the index, and the contents table."""

    records: str
    index: str
    contents: DataFrame

    def table_of_contents(self) -> list[tuple]:
        """Of each index file, in order: first entry, file, place and size of its directory."""
        return sorted((entry(bytes(r["first_key"]), r["first_id"]), r["file"], r["directory_at"], r["size"]) for r in self.contents.collect())


def build(pages: DataFrame, folder: str | None = None, least: int = LEAST, date: str = DATE) -> Archive:
    """Archives and index of the pages, in a new folder below the shared one unless another is named."""
    folder = folder or scratch_path(pages.sparkSession, "archive")
    records, blocks = f"{folder}/records", f"{folder}/index"
    return Archive(records, blocks, index(write(pages, records, least, date), blocks))


def lookup(archive: Archive, asked: DataFrame) -> DataFrame:
    """The captures of the (url, page_id) in ``asked``, each once: key, page_id, file, offset, length."""
    contents = archive.table_of_contents()
    firsts, folder = [c[0] for c in contents], archive.index

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for url, page_id in zip(batch.column("url").to_pylist(), batch.column("page_id").to_pylist()):
                key = url_key(url)
                want = entry(key, page_id)
                first = max(0, bisect.bisect_left(firsts, want) - 1)
                out.extend((n, key, page_id) for n in range(first, bisect.bisect_right(firsts, want)))
            yield batch_of(out, "number int, key binary, page_id bigint")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (fs, path), held, blocks = place(folder), None, None
        for batch in batches:
            out = []
            for number, key, page_id in zip(*(batch.column(c).to_pylist() for c in ("number", "key", "page_id"))):
                if number != held:
                    held, blocks = number, Blocks(fs, f"{path}/{contents[number][1]}", contents[number][2], contents[number][3])
                for row in blocks.find(key, page_id):
                    out.append(row)
                    if len(out) == BLOCK_ROWS:
                        yield batch_of(out, CAPTURE)
                        out = []
            yield batch_of(out, CAPTURE)

    asks = asked.select(F.col("url").cast("string").alias("url"), F.col("page_id").cast("bigint").alias("page_id")).mapInArrow(route, "number int, key binary, page_id bigint")
    # Ranges of (file, key, id) rather than files, so a file many ask for is shared by several tasks.
    order = ["number", "key", F.col("page_id").asc_nulls_last()]
    return asks.distinct().repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(find, CAPTURE)


def captures_under(archive: Archive, prefix: bytes) -> DataFrame:
    """The captures whose key starts with ``prefix`` (at most KEY_BYTES - 64 bytes), such as ``org,example`` for a domain."""
    contents = archive.table_of_contents()
    folder, spark = archive.index, archive.contents.sparkSession
    trimmed = prefix.rstrip(b"\xff")
    high = trimmed[:-1] + bytes([trimmed[-1] + 1]) if trimmed else None
    firsts = [c[0] for c in contents]
    first = max(0, bisect.bisect_left(firsts, (prefix, False, -(1 << 63))) - 1)
    stop = len(firsts) if high is None else max(first, bisect.bisect_left(firsts, (high, False, -(1 << 63))))
    numbers = spark.range(first, stop).repartition(max(1, stop - first), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = place(folder)
        for batch in batches:
            for number in batch.column("id").to_pylist():
                blocks, out = Blocks(fs, f"{path}/{contents[number][1]}", contents[number][2], contents[number][3]), []
                for row in blocks.under(prefix, high):
                    out.append(row)
                    if len(out) == BLOCK_ROWS:
                        yield batch_of(out, CAPTURE)
                        out = []
                yield batch_of(out, CAPTURE)

    return numbers.mapInArrow(run, CAPTURE)


def read(archive: Archive, captures: DataFrame, payloads: bool = True) -> DataFrame:
    """The records at the captures' ranges, checked: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload.

    Records near each other are read in one range. A revisit has no payload of its own; ``refers_to`` names the page that has.
    """
    folder = archive.records
    stretch = (F.col("offset") / STRETCH).cast("bigint")
    dealt = captures.select("file", "offset", "length", stretch.alias("stretch")).repartition("file", "stretch").sortWithinPartitions("file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (fs, path), name, file, have, data = place(folder), None, None, 0, b""
        for batch in batches:
            out, rows = [], list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))))
            for i, (wanted, offset, length) in enumerate(rows):
                if wanted != name:
                    name, file, have, data = wanted, fs.open_input_file(f"{path}/{wanted}"), 0, b""
                if not have <= offset or offset + length > have + len(data):
                    stop = offset + length
                    for later, at, size in rows[i + 1:]:
                        if later != name or at > stop + GAP or at + size - offset > 4 * GAP:
                            break
                        stop = max(stop, at + size)
                    have, data = offset, file.read_at(stop - offset, offset)
                found = parsed(gzip.decompress(data[offset - have:offset - have + length]))
                out.append(found if payloads else (*found[:-1], None))
            yield batch_of(out, RECORD)

    return dealt.mapInArrow(run, RECORD)


def digest(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: written, found by the index, and read back."""
    archive = build(pages, folder)
    records = read(archive, lookup(archive, pages), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def oracle(least: int = LEAST) -> str:
    """The same rows in DuckDB SQL."""
    return f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS t, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
    g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= {least} AND first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= {least} AND page_id IS DISTINCT FROM first THEN first END AS refers_to FROM g
    """
