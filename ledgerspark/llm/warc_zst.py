"""Operator 5, WARC archives compressed record by record with an embedded Zstandard dictionary."""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.session import scratch_dir

#: A frame that readers skip, reserved for the dictionary of an archive.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
SUFFIX = ".warc.zst"


@dataclass(frozen=True)
class Archive:
    """Bounds of an archive and of the dictionary's sample, in bytes; the level of compression."""

    archive_bytes: int = 16 << 20
    dictionary_bytes: int = 64 << 10
    sample_records: int = 300
    sample_bytes: int = 16 << 10
    level: int = 3
    #: Payloads of fewer bytes are never revisits.
    least_bytes: int = 0
    date: str = "2000-01-01T00:00:00Z"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers: int | None, revisit: bool, a: Archive) -> bytes:
    """One WARC/1.1 record. A revisit has no payload, but the length and digest of the full one."""
    kind = "revisit" if revisit else "response"
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{kind}:{page_id}:{digest}")
    target = (url or "urn:none").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        f"WARC-Date: {a.date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers is not None:
            head.append(f"X-Refers-To-Page: {refers}")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = http + (b"" if revisit else payload)
    head.append("Content-Type: application/http;msgtype=response")
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + body + b"\r\n\r\n"


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def read_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and payload of each record of an archive, decompressed with the dictionary of its first frame."""
    magic, size = struct.unpack_from("<II", content)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive does not begin with a dictionary frame")
    dictionary = content[8 : 8 + size]
    if dictionary[:4] == struct.pack("<I", FRAME_MAGIC):
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    stream = io.BufferedReader(reader.stream_reader(io.BytesIO(content[8 + size :]), read_across_frames=True))
    while line := stream.readline():
        head = [line]
        while line != b"\r\n":
            line = stream.readline()
            head.append(line)
        headers = dict(h.decode("utf-8", "replace").rstrip("\r\n").split(": ", 1) for h in head[1:-1])
        body = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield headers, body.partition(b"\r\n\r\n")[2]


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A dictionary of at most ``size`` bytes; the samples themselves where they are too few to train on."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:] if sum(map(len, samples)) >= 8 else b""


def _write(batches: Iterator[pa.RecordBatch], folder: str, dictionary: bytes, a: Archive):
    """Write the records of a partition to archives of its own, and give their names."""
    from pyspark import TaskContext

    task = TaskContext.get()
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    writer = zstandard.ZstdCompressor(level=a.level, dict_data=data, write_checksum=True)
    number, size, stream, held = 0, 0, None, ""

    def close() -> str:
        stream.close()
        final = f"{root}/part-{task.partitionId():06d}-{number:05d}{SUFFIX}"
        # An attempt that died leaves only its own unfinished name; the last to finish wins with the same content.
        store.move(held, final)
        return final

    names, records = [], []
    count = 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to", "revisit")]
        for page_id, url, payload, digest, refers, revisit in zip(*columns, strict=True):
            if stream is None:
                held = f"{root}/_part-{task.partitionId():06d}-{number:05d}-{task.taskAttemptId()}"
                stream = store.open_output_stream(held)
                stream.write(dictionary_frame(dictionary))
                size, count = 0, 0
            packed = writer.compress(record_bytes(page_id, url, payload, digest, refers, revisit, a))
            stream.write(packed)
            size += len(packed)
            count += 1
            if size >= a.archive_bytes:
                names.append(close())
                records.append(count)
                number, stream = number + 1, None
    if stream is not None:
        names.append(close())
        records.append(count)
    yield pa.RecordBatch.from_pydict({"archive": names, "records": pa.array(records, pa.int64())})


def write_archives(pages: DataFrame, folder: str, a: Archive = Archive()) -> DataFrame:
    """Write ``pages`` (``page_id, url, html``) below ``folder``; gives ``archive, records`` of what was written.

    The folder is one that all executors reach. Every record is a Zstandard frame of its own; the dictionary,
    trained on a bounded sample of the records chosen by hash, leads each archive in a skippable frame. Of records with equal
    payloads, the one with the largest page id is the response, and the others revisit it; only the
    payloads that occur more than once are joined back, and Spark broadcasts these only if they are small.

    Null HTML is an empty payload. Rows of one page id and payload are alike: all responses or all revisits. A
    null page id revisits any other id of its payload. An empty table writes no archive. Other columns are not read.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    digests = rows.select("page_id", "sha", F.octet_length("payload").alias("n"))
    again = (
        digests.where(F.col("n") >= a.least_bytes)
        .groupBy("sha")
        .agg(F.count("*").alias("copies"), F.max("page_id").alias("last"))
        .where("copies > 1")
        .select(F.col("sha").alias("again"), "last")
    )
    chosen = digests.where("n > 0").orderBy(F.xxhash64("sha", F.lit(1)), "page_id").limit(a.sample_records)
    chosen = chosen.select(F.col("sha").alias("chosen")).distinct()
    sample = rows.join(F.broadcast(chosen), F.col("sha") == F.col("chosen"), "left_semi").dropDuplicates(["sha"])
    sample = sample.select("sha", F.expr(f"substring(payload, 1, {a.sample_bytes})").alias("payload")).collect()
    dictionary = train_dictionary([bytes(r["payload"]) for r in sorted(sample)], a.dictionary_bytes)

    joined = rows.join(again, F.col("sha") == F.col("again"), "left").select(
        "page_id",
        "url",
        "payload",
        base32(F.col("sha")).alias("digest"),
        F.col("last").cast("bigint").alias("refers_to"),
        (F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))).alias("revisit"),
    )
    made = joined.mapInArrow(partial(_write, folder=folder, dictionary=dictionary, a=a), "archive string, records bigint")
    manifest = folder.rstrip("/") + "/_manifest"
    made.write.parquet(manifest)
    return spark.read.schema("archive string, records bigint").parquet(manifest)


def base32(hex_digest) -> F.Column:
    """Base32 of a hexadecimal SHA-1: 32 digits of 5 bits, from 8 groups of 20 bits."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    out = []
    for group in range(8):
        bits = F.conv(F.substring(hex_digest, group * 5 + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            out.append(F.substring(F.lit(alphabet), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*out)


def _read(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for content in batch.column("content").to_pylist():
            out: dict[str, list] = {n: [] for n in ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")}
            for headers, payload in read_archive(content):
                kind, length = headers["WARC-Type"], int(headers["X-Payload-Length"])
                digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and (len(payload) != length or digest_of(payload) != digest):
                    raise ValueError(f"damaged record of page {headers.get('X-Page-Id')}")
                refers = headers.get("X-Refers-To-Page")
                page = headers.get("X-Page-Id")
                out["page_id"].append(int(page) if page else None)
                out["url"].append(headers["WARC-Target-URI"])
                out["payload_bytes"].append(length)
                out["payload_digest"].append(digest)
                out["record_type"].append(kind)
                out["refers_to"].append(int(refers) if refers else None)
            yield pa.RecordBatch.from_pydict(
                {k: pa.array(v, pa.string() if k in ("url", "payload_digest", "record_type") else pa.int64()) for k, v in out.items()}
            )


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Headers of all records below ``folder``; every response's payload is checked against its digest."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(folder).select("content")
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return files.mapInArrow(_read, schema)


def archive_round_trip(pages: DataFrame, a: Archive = Archive()) -> DataFrame:
    """Archives of all pages in a new folder of the shared scratch space, read back."""
    spark = pages.sparkSession
    folder = scratch_dir(spark, "warc")
    if "://" not in folder:
        folder = "file://" + folder.removeprefix("file:")
    write_archives(pages, folder, a)
    return read_archives(spark, folder)
