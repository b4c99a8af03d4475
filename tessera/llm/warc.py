"""Operator 4: deterministic sharded WARC archives.

Records are range-sorted by URL and page id, so shards hold neighbouring URLs.  Where a shard
starts follows from the data alone: the keys are sorted once without their payloads, every key
gets its place in bytes, and a shard is an equal part of all bytes; their number is that of
``SHARD_BYTES`` in the total, at most ``MAX_SHARDS``.  So the same pages give the same archives,
whatever files, partitions or settings they come with.  A task writes its shard as gzip members,
one per record, and starts a new file when the compressed size passes ``max_bytes``.  WARC and HTTP headers,
lengths and SHA-1 digests are made anew from the payload.  A payload of at least
``MIN_REVISIT`` bytes that several pages have is stored once, with the largest page id;
the others become revisit records that name it.

Commit: a task writes under a temporary name with its own attempt id and reports the file in
a manifest row; Spark keeps the rows of successful attempts only.  The files that the
manifest names are then renamed, a step that can be repeated, and the final manifest is
written.  Readers open the files of the manifest and nothing else, so what a lost attempt
left behind is never read.  A file whose bytes, records or digest are not those of the manifest,
or that ends inside a record, is an error.

NULL html or URL counts as empty.  Pages that repeat the largest page id with the same
payload are all responses.  A NULL page id never is what others refer to.  An empty table
gives an empty manifest; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Emitter, rows_of, shuffle_partitions, written
from tessera.session import shared_dir

MIN_REVISIT = 1000
MAX_FILE_BYTES = 1 << 30
SHARD_BYTES = 8 << 20
#: The starts of all shards are in every task.
MAX_SHARDS = 20_000
_RECORD_BYTES = 512   # what a record has besides its payload, about
_END = b"\r\n\r\n"


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _headers(fields: list[tuple[str, str]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8") + b"\r\n"


def _clean(value: str) -> str:
    """A header value is one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page: dict) -> bytes:
    """One WARC record: a response, or a revisit without its payload."""
    payload = page["html"].encode("utf-8")
    revisit = page["refers_to"] is not None
    http = b"HTTP/1.1 200 OK\r\n" + _headers([("Content-Type", "text/html; charset=utf-8"),
                                              ("Content-Length", str(len(payload)))])
    block = http if revisit else http + payload
    digest = _sha1(payload)
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page['page_id']} {page['url']} {digest}")
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:uuid:{name}>"),
              ("WARC-Target-URI", _clean(page["url"])), ("WARC-Date", "1970-01-01T00:00:00Z"),
              ("WARC-Payload-Digest", digest), ("WARC-Block-Digest", _sha1(block)),
              ("X-Payload-Length", str(len(payload)))]
    if page["page_id"] is not None:
        fields.append(("X-Page-ID", str(page["page_id"])))
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("X-Refers-To-Page-ID", str(page["refers_to"]))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + _headers(fields) + block + _END


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record; a wrong length or digest is an error."""
    head, _, rest = data.partition(_END)
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != _END or _sha1(block) != fields["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return fields, block.partition(_END)[2]


class _File:
    """One archive under a temporary name."""

    def __init__(self, folder: str, shard: int, number: int, attempt: int):
        self.name = f"{shard:06d}-{number:04d}.warc.gz"
        self.temporary = f"_temporary/{attempt}-{self.name}"
        system, path = _open(folder)
        system.create_dir(f"{path}/_temporary", recursive=True)
        self.stream, self.digest = system.open_output_stream(f"{path}/{self.temporary}", compression=None), hashlib.sha1()
        self.size = self.records = 0

    def add(self, data: bytes) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packer.compress(data) + packer.flush()
        self.stream.write(member)
        self.digest.update(member)
        self.size += len(member)
        self.records += 1

    def close(self) -> tuple:
        self.stream.close()
        return self.name, self.temporary, self.size, self.records, self.digest.hexdigest()


_MANIFEST = pa.schema([("name", pa.string()), ("temporary", pa.string()), ("bytes", pa.int64()),
                       ("records", pa.int64()), ("sha1", pa.string())])
_MANIFEST_DDL = "name string, temporary string, bytes long, records long, sha1 string"


def revisits(pages: DataFrame) -> DataFrame:
    """(url, page_id, payload, refers_to) of every page whose payload another page stores.
    Only digests are shuffled, summed before; a digest that many pages have is a skewed join
    that Spark splits."""
    keyed = pages.select("url", "page_id", "payload", F.octet_length("html").alias("n"))
    first = (keyed.where(F.col("n") >= MIN_REVISIT).groupBy("payload")
             .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies"))
             .where("copies > 1 AND refers_to IS NOT NULL"))
    return (keyed.join(first, "payload").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
            .select("url", "page_id", "payload", "refers_to"))


KEY = ["url", "page_id", "payload"]


def _order(url: str, page_id: int | None, payload: str) -> tuple:
    """A key as Spark sorts it: by UTF-8 bytes, NULL first."""
    return url.encode("utf-8"), page_id is not None, page_id or 0, payload


def shard_starts(pages: DataFrame, shard_bytes: int, max_shards: int) -> list[tuple]:
    """The first key of every shard but the first, in order.  Which rows sort into which partition
    here has no influence: a key's place is the number of bytes before it."""
    keys = written(pages.select(*KEY, (F.octet_length("html") + _RECORD_BYTES).cast("long").alias("size"))
                   .repartitionByRange(shuffle_partitions(pages.sparkSession), *KEY)
                   .withColumn("part", F.spark_partition_id()), "warc_keys")
    parts = written(keys.groupBy("part").agg(F.sum("size").alias("bytes")), "warc_parts")
    before = parts.select("part", (F.sum("bytes").over(Window.orderBy("part")) - F.col("bytes")).alias("before"))
    total = parts.agg(F.sum("bytes")).first()[0] or 0
    shards = min(max_shards, -(-total // shard_bytes))
    if shards < 2:
        return []
    inside = F.sum("size").over(Window.partitionBy("part").orderBy(*KEY).rowsBetween(Window.unboundedPreceding, -1))
    place = (F.col("before") + F.coalesce(F.col("inside"), F.lit(0))).cast("decimal(38,0)")
    placed = keys.withColumn("inside", inside).join(before, "part")
    starts = (placed.withColumn("shard", (F.floor(place * shards / F.lit(total))).cast("int"))
              .groupBy("shard").agg(F.min(F.struct(*KEY)).alias("first")).where("shard > 0"))
    return sorted(_order(*r["first"]) for r in starts.collect())


def write_archives(pages: DataFrame, folder: str, max_bytes: int = MAX_FILE_BYTES, shard_bytes: int = SHARD_BYTES,
                   max_shards: int = MAX_SHARDS) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives under ``folder``; returns the manifest.

    The payloads are shuffled once, by shard; a row that says whom a page revisits is sorted to
    just before the page."""
    spark = pages.sparkSession
    clean = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    clean = clean.withColumn("payload", F.sha1("html"))
    key = KEY
    starts = shard_starts(clean, shard_bytes, max_shards)

    def shard_of(urls: pa.Array, ids: pa.Array, payloads: pa.Array) -> pa.Array:
        keys = zip(urls.to_pylist(), ids.to_pylist(), payloads.to_pylist())
        return pa.array([bisect_right(starts, _order(*k)) for k in keys], pa.int32())

    marks = revisits(clean).select(*key, "refers_to", F.lit(None).cast("string").alias("html"))
    ordered = (clean.select(*key, F.lit(None).cast("long").alias("refers_to"), "html").unionByName(marks)
               .withColumn("shard", F.arrow_udf(shard_of, "int")(*key)).repartitionById(len(starts) + 1, F.col("shard"))
               .drop("shard").sortWithinPartitions(*key, F.col("refers_to").asc_nulls_last()))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, file, number, out = TaskContext.get(), None, 0, Emitter(_MANIFEST)
        mark = {}
        for page in rows_of(batches):
            if page["html"] is None:
                mark = page
                continue
            known = all(mark.get(c) == page[c] for c in key) if mark else False
            page["refers_to"] = mark["refers_to"] if known else None
            if file is None:
                file, number = _File(folder, context.partitionId(), number, context.taskAttemptId()), number + 1
            file.add(record(page))
            if file.size >= max_bytes:
                yield from out.add(file.close())
                file = None
        if file is not None:
            yield from out.add(file.close())
        yield from out.rest()

    manifest = written(ordered.mapInArrow(write, _MANIFEST_DDL), "warc_manifest")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open(folder)
        for batch in batches:
            for r in rows_of([batch]):
                final, temporary = f"{path}/{r['name']}", f"{path}/{r['temporary']}"
                if system.get_file_info(temporary).type != fs.FileType.NotFound:
                    system.move(temporary, final)
                if system.get_file_info(final).size != r["bytes"]:
                    raise OSError(f"{r['name']} is missing or has a wrong size")
            yield batch

    committed = manifest.repartition(shuffle_partitions(spark)).mapInArrow(rename, _MANIFEST_DDL)
    committed.select("name", "bytes", "records", "sha1").write.mode("errorifexists").parquet(f"{folder}/_manifest")
    return spark.read.schema("name string, bytes long, records long, sha1 string").parquet(f"{folder}/_manifest")


def _members(stream) -> Iterator[bytes]:
    """Records of a file of gzip members, read in pieces.  A file that ends inside one is an error."""
    unpack, parts, data = zlib.decompressobj(31), [], b""
    while True:
        data = data or stream.read(1 << 20)
        if not data:
            if parts:
                raise ValueError("an archive ends inside a record")
            return
        parts.append(unpack.decompress(data))
        data = unpack.unused_data
        if unpack.eof:
            yield b"".join(parts)
            unpack, parts = zlib.decompressobj(31), []


class _Checked:
    """A stream that keeps the size and digest of what was read from it."""

    def __init__(self, stream):
        self.stream, self.size, self.digest = stream, 0, hashlib.sha1()

    def read(self, n: int) -> bytes:
        data = self.stream.read(n)
        self.size += len(data)
        self.digest.update(data)
        return data


_PAGES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                    ("html", pa.string())])
_PAGES_DDL = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long, html string")


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the manifest's files.  Length and digest of a response come from the
    payload read back, those of a revisit from its headers (it has no payload)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, (system, path) = Emitter(_PAGES), _open(folder)
        for r in rows_of(batches):
            with system.open_input_stream(f"{path}/{r['name']}", compression=None) as stream:
                checked, records = _Checked(stream), 0
                for data in _members(checked):
                    records += 1
                    fields, payload = parse(data)
                    response = fields["WARC-Type"] == "response"
                    if response and _sha1(payload) != fields["WARC-Payload-Digest"]:
                        raise ValueError(f"damaged payload {fields['WARC-Record-ID']}")
                    digest = base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex()
                    page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
                    row = (None if page is None else int(page), fields["WARC-Target-URI"],
                           len(payload) if response else int(fields["X-Payload-Length"]), digest, fields["WARC-Type"],
                           None if refers is None else int(refers),
                           payload.decode("utf-8") if response and with_payload else None)
                    yield from out.add(row, len(payload) if with_payload else 0)
                if (checked.size, records, checked.digest.hexdigest()) != (r["bytes"], r["records"], r["sha1"]):
                    raise ValueError(f"{r['name']} is not the file of the manifest")
        yield from out.rest()

    files = manifest.repartition(shuffle_partitions(manifest.sparkSession), "name")
    return files.select("name", "bytes", "records", "sha1").mapInArrow(read, _PAGES_DDL)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` into a new shared folder and read the records back."""
    folder = shared_dir(pages.sparkSession, "warc")
    manifest = write_archives(pages, folder)
    return read_archives(manifest, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
