"""Deterministic sharded WARC writer and reader (operator 1).

Records are ranged by id into shards of about ``SHARD_BYTES`` of payload: the
bytes before each id, summed in the order of ids over the cluster, say in which
shard it stands, so the shards follow from the data alone, whatever the number
of tasks, and are planned in a fixed number of jobs.  Each shard is a partition
of its own, sorted and written by one task, rolled to a new file by compressed
size.
Headers, record ids and digests are made anew; the response of
equal payloads is the record of the largest id, the others revisit it.

Commit: a task writes its files under temporary names with a name of its own
and returns their manifest rows; Spark keeps one set of rows per shard, however
often a task ran.  The rows are written as the manifest, then the files named
there get their final names, then a marker file is put in place.  Every step
can be repeated.  Readers take only files of a committed manifest.

Defined results: a null payload is empty; rows without an id are dealt to
shards after the others by their payload and have a record id from it; repeated rows are written each; of equal
payloads the largest id answers (a repeated row of that id too); an empty table
gives an archive without files and no record; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from matchstats.llm.common import dropped, ship_code, work_path, written
from matchstats.operators.rownum import prefix_sums

#: Payload bytes of a shard, and compressed bytes after which a file is rolled.
SHARD_BYTES = 64 << 20
FILE_BYTES = 16 << 20
#: Payloads of at least so many bytes are deduplicated.
LEAST_REVISIT_BYTES = 0
#: A date of its own would make equal input give unequal archives.
WARC_DATE = "2024-01-01T00:00:00Z"
GZIP_LEVEL = 5
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SPACE = uuid.UUID("5f3d9e4e-6d2c-5b8e-9c1f-0e7a3b6d4c21")
MANIFEST = "shard int, roll int, temporary string, final string, bytes long, records long, crc32 long"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """A file system and path that workers can write to, for a folder that is
    named as Spark names it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(RECORD_SPACE, name)}>"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record; refers_to: the id of the response that it revisits."""
    own = record_id(f"page {page_id}" if page_id is not None else f"payload {digest}")
    block = b"" if refers_to is not None else payload
    target = "".join(c if " " < c < "\x7f" else "%" + "%".join(f"{b:02X}" for b in c.encode("utf-8", "replace"))
                     for c in url or "")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}", f"WARC-Record-ID: {own}",
            f"WARC-Date: {WARC_DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
            f"WARC-Block-Digest: sha1:{payload_digest(block)}", "Content-Type: text/html; charset=utf-8"]
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(f'page {refers_to}')}",
                 f"WARC-Refers-To-Page-ID: {refers_to}", f"WARC-Payload-Length: {len(payload)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def plan_shards(sizes: DataFrame, target: int) -> tuple[list[int], int]:
    """(least ids of the shards after the first, number of shards for rows
    without an id), from rows (page_id, bytes).  One id per shard reaches the
    driver."""
    per_id = written(sizes.groupBy("page_id").agg(F.sum("bytes").alias("bytes"), F.lit(0).alias("one")), "page-sizes")
    named = prefix_sums(per_id.filter("page_id IS NOT NULL"), ["one"], ["page_id"], ["bytes"])
    shard = F.expr(f"(cum_bytes - bytes) div {int(target)}")
    least = sorted(r["least"] for r in named.groupBy(shard.alias("s")).agg(F.min("page_id").alias("least")).collect())
    unnamed = per_id.filter("page_id IS NULL").agg(F.sum("bytes")).first()[0]
    dropped(per_id)
    return least[1:], 0 if unnamed is None else max(1, -(-unnamed // target))


class _Roller:
    """Writes one shard's records to files of about ``limit`` compressed bytes."""

    def __init__(self, fs, root: str, shard: int, attempt: str, limit: int):
        self.fs, self.root, self.shard, self.attempt, self.limit = fs, root, shard, attempt, limit
        self.roll, self.out, self.rows = 0, None, []

    def write(self, raw: bytes) -> None:
        if self.out is None:
            name = f"part-{self.shard:07d}-{self.roll:05d}.warc.gz"
            self.names = (posixpath.join("_temporary", f"{name}.{self.attempt}"), name)
            self.out = self.fs.open_output_stream(posixpath.join(self.root, self.names[0]), compression=None)
            self.bytes = self.records = self.crc = 0
        z = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)  # gzip without a time
        data = z.compress(raw) + z.flush()
        self.out.write(data)
        self.bytes, self.records, self.crc = self.bytes + len(data), self.records + 1, zlib.crc32(data, self.crc)
        if self.bytes >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.rows.append((self.shard, self.roll, *self.names, self.bytes, self.records, self.crc))
            self.roll, self.out = self.roll + 1, None


def write_archive(pages: DataFrame, path: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Write rows (page_id, url, html) as a committed archive below ``path``."""
    spark = pages.sparkSession
    ship_code(spark)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"))
    bounds, unnamed = plan_shards(rows.select("page_id", F.octet_length("html").cast("long").alias("bytes")), shard_bytes)
    edges, shards = np.array(bounds, np.int64), len(bounds) + 1

    # one narrow row per page decides what answers for its payload
    digest = F.unhex(F.sha1("html"))
    slim = rows.select("page_id", digest.alias("digest"), F.octet_length("html").alias("n"))
    answers = slim.groupBy("digest", "n").agg(F.max("page_id").alias("response"))
    decided = (slim.filter(F.col("n") >= LEAST_REVISIT_BYTES).join(answers, ["digest", "n"])
               .filter("page_id is null and response is not null or page_id < response")
               .select("page_id", "digest", "response").distinct())
    # decisions and pages go to the same shard, the decision first
    both = decided.select("page_id", "digest", F.lit(0).alias("o"), "response", F.lit(None).cast("string").alias("url"),
                          F.lit(None).cast("string").alias("html")).unionByName(
        rows.select("page_id", digest.alias("digest"), F.lit(1).alias("o"), F.lit(None).cast("long").alias("response"),
                    "url", "html"))

    @pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        return pd.Series(np.where(known, np.searchsorted(edges, ids.where(known, 0).to_numpy().astype(np.int64),
                                                         side="right"), 0).astype(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(path)
        attempt, roller, known = uuid.uuid4().hex, None, None
        finished: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                if roller is None or roller.shard != row["shard"]:
                    if roller is not None:
                        roller.close()
                        finished += roller.rows
                    roller = _Roller(fs, root, row["shard"], attempt, file_bytes)
                key = (row["page_id"], row["digest"])
                if row["o"] == 0:
                    known = (key, row["response"])
                    continue
                payload = row["html"].encode("utf-8", "surrogatepass")
                refers = known[1] if known is not None and known[0] == key else None
                roller.write(record(row["page_id"], row["url"], payload, base64.b32encode(row["digest"]).decode(), refers))
        if roller is not None:
            roller.close()
            finished += roller.rows
        columns = list(zip(*finished)) or [()] * 7
        types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                         ["shard", "roll", "temporary", "final", "bytes", "records", "crc32"])

    fs, root = filesystem(path)
    fs.create_dir(posixpath.join(root, "_temporary"), recursive=True)
    spread = F.lit(shards) + F.pmod(F.xxhash64("digest"), F.lit(max(1, unnamed))).cast("int")
    shard = F.when(F.col("page_id").isNull(), spread).otherwise(shard_of("page_id"))
    dealt = (both.withColumn("shard", shard).repartitionById(shards + unnamed, F.col("shard"))
             .sortWithinPartitions("shard", "page_id", "digest", "o", "url"))
    dealt.mapInArrow(run, MANIFEST).write.parquet(f"{path}/_manifest")
    commit(spark, path)


def commit(spark: SparkSession, path: str) -> None:
    """Give the manifest's files their final names, then mark the archive; can
    be repeated after any failure."""
    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(path)
        for batch in batches:
            for row in batch.to_pylist():
                old, new = posixpath.join(root, row["temporary"]), posixpath.join(root, row["final"])
                if fs.get_file_info(old).type == pafs.FileType.File:
                    fs.move(old, new)
                found = fs.get_file_info(new)
                if found.type != pafs.FileType.File or found.size != row["bytes"]:
                    raise OSError(f"{new}: missing or not of the manifest's size")
            yield pa.RecordBatch.from_arrays([batch.column("records")], ["records"])

    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/_manifest")
    total = manifest.mapInArrow(rename, "records long").agg(F.sum("records")).first()[0] or 0
    fs, root = filesystem(path)
    temporary = posixpath.join(root, f"_COMMITTED.{uuid.uuid4().hex}")
    with fs.open_output_stream(temporary) as out:
        out.write(f"{total}\n".encode())
    fs.move(temporary, posixpath.join(root, "_COMMITTED"))


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a gzip stream, member by member."""
    z, raw, pending = zlib.decompressobj(31), bytearray(), b""
    while True:
        data = pending or stream.read(1 << 20)
        if not data:
            break
        raw += z.decompress(data)
        pending = b""
        if z.eof:
            pending, z = z.unused_data, zlib.decompressobj(31)
            end = raw.index(b"\r\n\r\n")
            lines = raw[:end].decode().split("\r\n")
            headers = dict(line.split(": ", 1) for line in lines[1:])
            block = bytes(raw[end + 4: end + 4 + int(headers["Content-Length"])])
            if len(raw) != end + 8 + len(block):
                raise ValueError("a record's length does not fit its header")
            yield headers, block
            raw = bytearray()
    if raw:
        raise ValueError("the archive ends within a record")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of
    every record of a committed archive.  Payload digests and block digests
    are computed again from what was read, and must agree with the headers."""
    ship_code(spark)
    fs, root = filesystem(path)
    if fs.get_file_info(posixpath.join(root, "_COMMITTED")).type != pafs.FileType.File:
        raise FileNotFoundError(f"{path} holds no committed archive")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(path)
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for batch in batches:
            for name in batch.column("final").to_pylist():
                rows = []
                with fs.open_input_stream(posixpath.join(root, name), compression=None) as stream:
                    for h, block in parse(stream):
                        own = payload_digest(block)
                        said = h["WARC-Payload-Digest"].removeprefix("sha1:")
                        revisit = h["WARC-Type"] == "revisit"
                        if h["WARC-Block-Digest"] != f"sha1:{own}" or not revisit and said != own:
                            raise ValueError(f"{name}: a digest does not fit its record")
                        page, refers = h.get("WARC-Page-ID"), h.get("WARC-Refers-To-Page-ID")
                        rows.append((int(page) if page else None,
                                     int(h["WARC-Payload-Length"]) if revisit else len(block), said,
                                     h["WARC-Type"], int(refers) if refers else None))
                columns = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    # a file is one unit of work, whatever the size of the manifest's rows
    files = spark.read.schema(MANIFEST).parquet(f"{path}/_manifest").select("shard", "roll", "final")
    spread = files.repartition(max(1, files.count()), "shard", "roll")
    return spread.select("final").mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to a new archive in the shared folder and read it back."""
    path = work_path(pages.sparkSession, "warc")
    write_archive(pages, path)
    return read_archive(pages.sparkSession, path)
