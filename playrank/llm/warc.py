"""WARC archives: a task-parallel writer and a Python data source that reads them back.

The writer turns rows into files of limited size in a shared folder. Every task attempt writes under names of its own and
reports them; only reported files are read, so a lost or repeated attempt leaves nothing behind that counts.

The source plans one partition per file. Filters on the record type and on header fields are pushed down; a record's header
is parsed first, and where the record is not wanted, or the payload is not (option ``payload`` = ``skip``), its block is passed
over: by a seek in a plain file, unpacked but neither kept nor decoded in a compressed one.
"""

from __future__ import annotations

import base64
import gzip
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, IsNull

from playrank.llm.runs import join_by_share, split_by_keys
from playrank.session import materialize, new_path

FILE_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

SCHEMA = "record_id string, warc_type string, target_uri string, payload_digest string, refers_to string, payload_length bigint, payload binary"
HEADER_OF = {"record_id": "warc-record-id", "warc_type": "warc-type", "target_uri": "warc-target-uri", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}


def file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The store that a path or URI names, and the path in it."""
    return pa.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pa.fs.LocalFileSystem(), path)


def record_bytes(record_id: str, kind: str, uri: str | None, digest: str, length: int, refers_to: str | None, payload: bytes) -> bytes:
    """One record; ``digest`` is the payload's SHA-1 in hex. A revisit carries the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    if uri is not None:
        head.append("WARC-Target-URI: " + " ".join(uri.split()))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(records: DataFrame, path: str | None = None, compress: bool = True, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write records (record_id, warc_type, target_uri, payload_digest, refers_to, payload_length, payload); returns the manifest (file, records).

    ``payload_digest`` is hex SHA-1. A null payload counts as empty. ``compress`` makes every record a gzip member of its own,
    as archives mostly are: a fraction of the disk, but a reader has to unpack what it passes over; plain files are skipped by seeks.
    """
    path = path or new_path(records.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = file_system(path)
        store.create_dir(folder, recursive=True)
        out, name, size, count = None, "", 0, 0
        done: list[tuple[str, int]] = []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, size, count = f"part-{uuid.uuid4().hex}.warc" + ".gz" * compress, 0, 0
                    out = store.open_output_stream(f"{folder}/{name}", compression=None)
                raw = record_bytes(row["record_id"], row["warc_type"], row["target_uri"], row["payload_digest"], row["payload_length"], row["refers_to"], row["payload"] or b"")
                size += out.write(gzip.compress(raw, 6) if compress else raw)
                count += 1
                if size >= file_bytes:
                    out.close()
                    done.append((name, count))
                    out = None
        if out is not None:
            out.close()
            done.append((name, count))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([f"{path}/{n}" for n, _ in done]), pa.array([c for _, c in done], pa.int64())], ["file", "records"])

    return materialize(records.mapInArrow(run, "file string, records bigint"), "manifest")


class _Input:
    """Bytes of a file, read ahead in blocks; what is skipped in a plain file is not read."""

    def __init__(self, file: str) -> None:
        store, name = file_system(file)
        self.raw = store.open_input_file(name)
        self.packed = gzip.GzipFile(fileobj=self.raw) if name.endswith(".gz") else None
        self.buffer, self.at, self.place = b"", 0, 0

    def _more(self) -> bool:
        new = self.packed.read(1 << 20) if self.packed else self.raw.read(1 << 20)
        self.place += len(new)
        self.buffer, self.at = self.buffer[self.at :] + new, 0
        return bool(new)

    def until(self, mark: bytes, limit: int | None = None) -> bytes | None:
        """Bytes up to and with the mark; None at the end of the file. With a limit, None too if the mark is not within it."""
        seen = self.at
        while (found := self.buffer.find(mark, seen, None if limit is None else self.at + limit)) < 0:
            had = len(self.buffer) - self.at
            if limit is not None and had >= limit:
                return None
            if not self._more():
                if limit is not None or self.buffer.strip():
                    raise ValueError("a WARC record breaks off")
                return None
            seen = max(0, had - len(mark))
        result = self.buffer[self.at : found + len(mark)]
        self.at = found + len(mark)
        return result

    def take(self, n: int) -> bytes:
        while len(self.buffer) - self.at < n:
            if not self._more():
                raise ValueError("a WARC record breaks off")
        result = self.buffer[self.at : self.at + n]
        self.at += n
        return result

    def skip(self, n: int) -> None:
        here = len(self.buffer) - self.at
        if n <= here:
            self.at += n
        elif self.packed is None:
            self.place += n - here
            self.raw.seek(self.place)
            self.buffer, self.at = b"", 0
        else:  # a packed file has to be unpacked to be passed over, but is not kept
            while n > len(self.buffer) - self.at:
                n -= len(self.buffer) - self.at
                self.buffer, self.at = b"", 0
                if not self._more():
                    raise ValueError("a WARC record breaks off")
            self.at += n

    def close(self) -> None:
        self.raw.close()


def fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:] if line)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def digest_of(value: str | None) -> str | None:
    """A SHA-1 in base 32 as bare hexadecimal digits; any other digest as it stands."""
    if value and value.lower().startswith("sha1:") and len(value) == 37:
        try:
            return base64.b32decode(value[5:].upper()).hex()
        except ValueError:
            return value
    return value


def stated_length(http: bytes) -> int | None:
    """The length that an HTTP head states, if it states one."""
    value = fields(http).get("content-length", "")
    return int(value) if value.isascii() and value.isdigit() else None


class WarcPartition(InputPartition):
    def __init__(self, file: str) -> None:
        self.file = file


class WarcReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.manifest = options.get("manifest")
        self.path = options.get("path")
        self.skip_payload = options.get("payload") == "skip"
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters):  # noqa: N802
        """Keep what compares a header field with values; the rest is left to Spark."""
        for f in filters:
            name = getattr(f, "attribute", ("",))[0]
            if name in HEADER_OF and isinstance(f, EqualTo):
                self.tests.append((name, "in", (f.value,)))
            elif name in HEADER_OF and isinstance(f, In):
                self.tests.append((name, "in", tuple(f.value)))
            elif name in HEADER_OF and isinstance(f, IsNull):
                self.tests.append((name, "null", ()))
            elif name in HEADER_OF and isinstance(f, IsNotNull):
                self.tests.append((name, "not null", ()))
            else:
                yield f

    def partitions(self) -> list[WarcPartition]:
        if self.manifest:
            store, name = file_system(self.manifest)
            listed = pa.dataset.dataset(name, filesystem=store, format="parquet").to_table(columns=["file"])
            return [WarcPartition(f) for f in listed["file"].to_pylist()]
        store, folder = file_system(self.path)
        found = store.get_file_info(pa.fs.FileSelector(folder, recursive=True))
        base = self.path[: len(self.path) - len(folder)]
        return [WarcPartition(base + f.path) for f in found if f.path.endswith((".warc", ".warc.gz"))]

    def _wanted(self, row: dict) -> bool:
        for name, test, values in self.tests:
            value = row[name]
            if (test == "null") != (value is None) if test != "in" else value not in values:
                return False
        return True

    def read(self, partition: WarcPartition) -> Iterator[pa.RecordBatch]:
        if partition is None:  # an empty folder
            return
        names = [*HEADER_OF, "payload_length", "payload"]
        rows: list[dict] = []
        held = 0
        source = _Input(partition.file)

        def batch() -> pa.RecordBatch:
            kinds = [pa.string()] * len(HEADER_OF) + [pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, kinds, strict=True)], names)

        try:
            while (head := source.until(b"\r\n\r\n")) is not None:
                header = fields(head.lstrip())
                if not header.get("content-length", "").isdigit():
                    raise ValueError("a WARC record without a length")
                length = int(header["content-length"])
                row: dict = {n: header.get(h) for n, h in HEADER_OF.items()}
                for n in ("record_id", "refers_to"):
                    row[n] = row[n] and row[n].strip("<>")
                row["payload_digest"] = digest_of(row["payload_digest"])
                if not self._wanted(row):
                    source.skip(length + 4)
                    continue
                # A block without a blank line has no HTTP head; all of it is payload then.
                http = (source.until(b"\r\n\r\n", length) or b"") if "application/http" in header.get("content-type", "") else b""
                rest = length - len(http)
                # What a revisit leaves out is only stated; all else has the length that is there.
                stated = stated_length(http) if row["warc_type"] == "revisit" else None
                row["payload_length"] = rest if stated is None else stated
                if self.skip_payload or row["warc_type"] == "revisit":
                    row["payload"] = None
                    source.skip(rest + 4)
                else:
                    row["payload"] = source.take(rest)
                    source.skip(4)
                    held += rest
                rows.append(row)
                if held >= BATCH_BYTES or len(rows) >= 10_000:
                    yield batch()
                    rows, held = [], 0
            if rows:
                yield batch()
        finally:
            source.close()


class WarcDataSource(DataSource):
    """Format ``warc``. Options: ``path`` (folder) or ``manifest`` (Parquet of file names), ``payload`` = ``skip`` or ``read``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))


def read_warc(spark: SparkSession, path: str, payload: bool = True, manifest: bool = False) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").option("manifest" if manifest else "path", path).option("payload", "read" if payload else "skip").load()


def page_records(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Records for ``write_warc`` from pages (page_id, url, html).

    Of pages with equal payloads of at least ``least_bytes`` the one with the largest page_id is the response, the others
    revisit it. A null html is an empty payload; rows with the same page_id and payload are responses alike; an empty
    table gives no rows; other columns are left aside.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    sized = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("target_uri"), payload.alias("payload"))
    sized = sized.withColumns({"payload_digest": F.sha1("payload"), "payload_length": F.octet_length("payload").cast("bigint")})
    large = sized.where(F.col("payload_length") >= least_bytes).groupBy("payload_digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    large = materialize(large.where("n > 1"), "repeated")
    # Only pages whose payload may be repeated are shuffled, and a payload that many share is not one task's group.
    sized = sized.withColumn("hash", F.xxhash64("payload_digest"))
    asked, others = split_by_keys(sized, "hash", large.select(F.xxhash64("payload_digest").alias("hash")))
    found = join_by_share(asked, large, ["payload_digest"], pages.count(), how="left").unionByName(others.withColumn("first", F.lit(None).cast("bigint")))
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return found.select(
        name("page_id").alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("warc_type"),
        "target_uri",
        "payload_digest",
        F.when(again, name("first")).alias("refers_to"),
        "payload_length",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write the pages, read the archives back: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    Length and digest of responses are taken from the payload that was read; revisits are read by their headers only.
    """
    spark = pages.sparkSession
    manifest = write_warc(page_records(pages))
    place = manifest.inputFiles()[0].rsplit("/", 1)[0] if manifest.inputFiles() else None
    if place is None:
        return spark.createDataFrame([], "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")
    number = lambda c: F.nullif(F.replace(F.col(c), F.lit("urn:page:")), F.lit("")).cast("bigint")
    full = read_warc(spark, place, manifest=True).where("warc_type = 'response'")
    heads = read_warc(spark, place, payload=False, manifest=True).where("warc_type = 'revisit'")
    full = full.select("record_id", F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), "warc_type", "refers_to")
    heads = heads.select("record_id", F.col("payload_length").alias("payload_bytes"), "payload_digest", "warc_type", "refers_to")
    both = full.unionByName(heads)
    return both.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), number("refers_to").alias("refers_to"))
