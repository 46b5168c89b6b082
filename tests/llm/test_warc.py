"""Operator 5: exact round trip, dictionary frame, independent records, revisits."""

import hashlib
import struct

import zstandard

from ledgerspark.llm.warc_zst import Archive, archive_round_trip, digest_of, read_archive, write_archives
from ledgerspark.session import scratch_dir

PAGES = "page_id bigint, url string, html string, digest string"


def test_round_trip_and_frames(spark):
    html = [f"<html><body>{'text ' * (i % 50)} page é {i}</body></html>" for i in range(400)]
    rows = [(i, f"http://host/{i}", h, None) for i, h in enumerate(html)]
    folder = "file://" + scratch_dir(spark, "warc").removeprefix("file:").replace("//", "/")
    made = write_archives(spark.createDataFrame(rows, PAGES).repartition(2), folder, Archive(archive_bytes=4000)).collect()
    assert sum(r["records"] for r in made) == 400 and len(made) > 2
    seen = {}
    for r in made:
        content = open(r["archive"], "rb").read()
        magic, size = struct.unpack_from("<II", content)
        assert magic == 0x184D2A5D and size > 0
        decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content[8 : 8 + size]))
        rest, frames = content[8 + size :], 0
        while rest:
            one = decompressor.decompressobj()
            assert one.decompress(rest).startswith(b"WARC/1.1")
            rest, frames = one.unused_data, frames + 1
        assert frames == r["records"]
        for headers, payload in read_archive(content):
            seen[int(headers["X-Page-Id"])] = payload.decode()
    assert seen == dict(enumerate(html))


def test_revisits_and_edges(spark):
    rows = [(1, "u", "same", None), (5, None, "same", None), (3, "a\nb", "same", None), (7, "u", None, None), (8, "u", "", None)]
    rows += [(None, "u", "same", None), (9, "u", "alone\r\n\r\nline", None), (9, "u", "alone\r\n\r\nline", None)]
    got = sorted(archive_round_trip(spark.createDataFrame(rows, PAGES)).collect(), key=repr)
    kinds = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in got), key=repr)
    assert kinds == sorted(
        [(1, "revisit", 5), (3, "revisit", 5), (5, "response", None), (7, "revisit", 8), (8, "response", None)]
        + [(None, "revisit", 5), (9, "response", None), (9, "response", None)],
        key=repr,
    )
    assert {r["payload_digest"] for r in got if r["page_id"] in (7, 8)} == {digest_of(b"")}
    assert digest_of(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    assert len(hashlib.sha1(b"").digest()) == 20
    assert archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0
