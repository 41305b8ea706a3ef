"""Web pages to WARC archives and back.

Records are range-partitioned by ``page_id`` at bounds that depend on the ids alone, sorted, and written to
files that are rolled by compressed size, one gzip member per record: the same pages give the same
bytes. A task writes under names of its own attempt and returns manifest rows; Spark commits the rows of
one attempt per task, and a second job gives exactly those files their final names. Readers follow
the manifest, so files of lost or doubled attempts are never seen.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from clickflow.scratch import fresh_dir

ROLL_BYTES = 64 << 20
REVISIT_BYTES = 100
_BOUND_SAMPLES = 32
_NAMESPACE = uuid.UUID("5f0c7f3e-3a52-4f0e-9f42-6d1f5c1f7a10")
_DATE = "2000-01-01T00:00:00Z"
_MANIFEST = (
    "shard int, part int, name string, temporary string, records long, bytes long, sha256 string, "
    "first_id long, last_id long"
)


def revisits(pages: DataFrame, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, digest, refers_to`` of the pages whose payload an earlier ``page_id`` has.

    Only digests are shuffled. Elections combine before the shuffle; the join back is one that Spark
    splits when a digest is hot. A null ``page_id`` takes no part.
    """
    payload = F.coalesce("html", F.lit(""))
    digests = pages.where(
        F.col("page_id").isNotNull() & (F.octet_length(payload) >= min_bytes)
    ).select("page_id", F.sha2(payload, 256).alias("digest"))
    first = (
        digests.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
        .where(F.col("last") > F.col("refers_to"))
        .drop("last")
    )
    return digests.join(first, "digest").where(F.col("page_id") > F.col("refers_to")).select(
        "page_id", "digest", "refers_to"
    )


def shard_bounds(pages: DataFrame, shards: int) -> list[int]:
    """Ids that begin a new shard: quantiles of the ids with the smallest hashes.

    The hashes choose the same ids however the table is split; a fixed number per shard is collected.
    """
    ids = pages.where(F.col("page_id").isNotNull()).groupBy("page_id").agg(F.count("*").alias("n"))
    chosen = ids.orderBy(F.xxhash64("page_id"), "page_id").limit(_BOUND_SAMPLES * shards)
    sample = sorted(row["page_id"] for row in chosen.select("page_id").collect())
    return sorted({sample[len(sample) * k // shards] for k in range(1, shards)}) if sample else []


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}:{digest}')}>"


def _clean_url(url: str | None, page_id: int | None) -> str:
    if not url:
        return f"urn:page:{page_id}"
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def warc_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record. A revisit keeps the HTTP header and leaves the payload to the record it refers to."""
    digest = hashlib.sha256(payload).hexdigest()
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _record_id(page_id, digest + ("" if refers_to is None else ":revisit")),
        "WARC-Date": _DATE,
        "WARC-Target-URI": _clean_url(url, page_id),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http; msgtype=response",
        "Page-Id": "" if page_id is None else str(page_id),
        "Payload-Length": str(len(payload)),
    }
    if refers_to is None:
        block += payload
    else:
        head |= {
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "WARC-Refers-To": _record_id(refers_to, digest),
            "Refers-To-Page-Id": str(refers_to),
        }
    head |= {
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Files:
    """The files of one shard, by one attempt of its task."""

    def __init__(self, root: str, shard: int, attempt: int, roll_bytes: int):
        from pyarrow.fs import FileSystem

        self.fs, self.path = FileSystem.from_uri(root)
        self.shard, self.attempt, self.roll = shard, attempt, roll_bytes
        self.part, self.out = 0, None

    def add(self, page_id: int | None, data: bytes) -> Iterator[tuple]:
        if self.out is None:
            self.name = f"records-{self.shard:06d}-{self.part:06d}.warc.gz"
            self.temporary = f"_temporary/{self.name}.{self.attempt}"
            self.fs.create_dir(f"{self.path}/_temporary", recursive=True)
            self.out = self.fs.open_output_stream(f"{self.path}/{self.temporary}", compression=None)
            self.records, self.bytes, self.hash, self.first = 0, 0, hashlib.sha256(), page_id
        self.out.write(data)
        self.hash.update(data)
        self.records, self.bytes, self.last = self.records + 1, self.bytes + len(data), page_id
        if self.bytes >= self.roll:
            yield self.close()

    def close(self) -> tuple:
        self.out.close()
        self.out = None
        self.part += 1
        return (
            self.shard, self.part - 1, self.name, self.temporary,
            self.records, self.bytes, self.hash.hexdigest(), self.first, self.last,
        )


def write_warc(pages: DataFrame, path: str, shards: int | None = None, roll_bytes: int = ROLL_BYTES) -> None:
    """Write ``page_id, url, html`` to a new folder that every executor reaches under ``path``.

    A null html is an empty payload, a null url becomes ``urn:page:ID``. Rows with a null ``page_id`` are
    responses and are spread over the shards by their payload; of rows that repeat a ``page_id``,
    those of the smallest id are all responses. An empty table gives an empty manifest. Other columns
    are not read. The page texts are shuffled once; decisions travel beside them and meet them by order.
    """
    spark = pages.sparkSession
    pages = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = np.array(shard_bounds(pages, shards), dtype=np.int64)

    @F.pandas_udf(IntegerType())
    def shard_of(page_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, page_id.to_numpy(np.int64), side="right").astype(np.int32))

    spread = F.pmod(F.xxhash64("html"), F.lit(shards)).cast("int")
    both = revisits(pages).select(
        "page_id", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.col("digest").alias("body"),
        "refers_to", F.lit(0).alias("loose"),
    ).unionByName(
        pages.select(
            "page_id", F.lit(1).alias("kind"), "url", F.col("html").alias("body"),
            F.lit(None).cast("long").alias("refers_to"),
            F.when(F.col("page_id").isNull(), spread).otherwise(0).alias("loose"),
        )
    )
    placed = both.withColumn(
        "shard",
        F.when(F.col("page_id").isNull(), F.col("loose")).otherwise(shard_of(F.coalesce("page_id", F.lit(0)))),
    )
    ordered = (
        placed.repartitionById(shards, "shard")
        .sortWithinPartitions("shard", "page_id", "kind", "url", "body")
        .select("shard", "page_id", "kind", "url", "body", "refers_to")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        schema = pa.schema(
            [("shard", pa.int32()), ("part", pa.int32()), ("name", pa.string()), ("temporary", pa.string()),
             ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string()),
             ("first_id", pa.int64()), ("last_id", pa.int64())]
        )
        done, files, current, known = [], None, None, {}
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for row in batch.slice(start, 256).to_pylist():
                    if files is None:
                        files = _Files(path, row["shard"], attempt, roll_bytes)
                    if row["page_id"] != current:
                        current, known = row["page_id"], {}
                    if row["kind"] == 0:
                        known[row["body"]] = row["refers_to"]
                        continue
                    payload = row["body"].encode()
                    refers_to = known.get(hashlib.sha256(payload).hexdigest()) if known else None
                    data = _gzip(warc_record(current, row["url"], payload, refers_to))
                    done += files.add(current, data)
        if files is not None and files.out is not None:
            done.append(files.close())
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, d, strict=True)) for d in done], schema)

    ordered.mapInArrow(write, _MANIFEST).write.parquet(f"{path}/_manifest")
    _commit(spark, path)


def _commit(spark: SparkSession, path: str) -> None:
    """Give the files of the manifest their names. Repeats do nothing; other attempts' files go last."""
    from pyarrow.fs import FileSystem, FileType

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = FileSystem.from_uri(path)
        for batch in batches:
            for name, temporary, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if fs.get_file_info(f"{root}/{name}").type == FileType.NotFound:
                    fs.move(f"{root}/{temporary}", f"{root}/{name}")
                found = fs.get_file_info(f"{root}/{name}").size
                if found != size:
                    raise ValueError(f"{name} has {found} bytes, the manifest says {size}")
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["name"])

    manifest(spark, path).select("name", "temporary", "bytes").mapInArrow(rename, "name string").count()
    fs, root = FileSystem.from_uri(path)
    if fs.get_file_info(f"{root}/_temporary").type != FileType.NotFound:
        fs.delete_dir(f"{root}/_temporary")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per archive: its records, bytes, checksum, first and last ``page_id``."""
    return spark.read.schema(_MANIFEST).parquet(f"{path}/_manifest")


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    unpacker, out = zlib.decompressobj(31), []
    data = stream.read(1 << 20)
    while data:
        out.append(unpacker.decompress(data))
        if unpacker.eof:
            yield b"".join(out)
            data = unpacker.unused_data or stream.read(1 << 20)
            unpacker, out = zlib.decompressobj(31), []
        else:
            data = stream.read(1 << 20)
    if out:
        raise ValueError("the last record of an archive is cut")


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields, and the payload behind the HTTP header. Lengths and digests are checked."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    checks = [("WARC-Block-Digest", block)]
    if fields["WARC-Type"] == "response":
        checks.append(("WARC-Payload-Digest", payload))
    for name, data in checks:
        if fields[name] != f"sha256:{hashlib.sha256(data).hexdigest()}":
            raise ValueError(f"{name} does not hold for {fields['WARC-Record-ID']}")
    return fields, payload


_RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_warc(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of the archives in the manifest, one task per archive or more archives.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload, also for a revisit.
    ``payloads`` adds the column ``payload``, null for a revisit.
    """
    schema = _RECORDS + (", payload binary" if payloads else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        names = [f.split()[0] for f in schema.split(", ")]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)], names
            )

        fs, root = FileSystem.from_uri(path)
        for batch in batches:
            rows: list[tuple] = []
            for name in batch.column(0).to_pylist():
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for record in _members(stream):
                        head, payload = parse_record(record)
                        row = (
                            int(head["Page-Id"]) if head["Page-Id"] else None,
                            head["WARC-Target-URI"],
                            int(head["Payload-Length"]),
                            head["WARC-Payload-Digest"].removeprefix("sha256:"),
                            head["WARC-Type"],
                            int(head["Refers-To-Page-Id"]) if "Refers-To-Page-Id" in head else None,
                        )
                        full = payload if head["WARC-Type"] == "response" else None
                        rows.append((*row, full) if payloads else row)
                        if len(rows) >= 512:
                            yield batch_of(rows)
                            rows = []
            if rows:
                yield batch_of(rows)

    archives = manifest(spark, path).select("name", "bytes")
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return archives.repartition(spread, "name").select("name").mapInArrow(read, schema)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_warc(spark, path).drop("url")


OP4_SQL = """
with p as (
  select page_id, coalesce(html, '') as html, sha256(coalesce(html, '')) as digest,
         strlen(coalesce(html, '')) as n
  from pages
), f as (
  select *, case when n >= 100 then min(page_id) over (partition by digest) end as first from p
)
select page_id, cast(n as bigint) as payload_bytes, digest as payload_digest,
       case when page_id > first then 'revisit' else 'response' end as record_type,
       case when page_id > first then first end as refers_to
from f
"""
