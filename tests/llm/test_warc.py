import hashlib
import io
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from tripmill.llm import warc
from tripmill.plans.staging import fresh_folder

SCHEMA = "page_id bigint, url string, html string, digest string, n int, key string, archive string"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1, "k", "a") for i, u, h in rows], SCHEMA).repartition(3)


def brute(rows):
    """Expected records as a sorted list of (page_id, url kept, bytes, digest, type, refers_to)."""
    groups = {}
    for i, _, h in rows:
        payload = (h or "").encode()
        if len(payload) >= warc.LEAST_PAYLOAD:
            groups.setdefault(payload, []).append(i)
    found = []
    for i, _, h in rows:
        payload = (h or "").encode()
        ids = groups.get(payload, [])
        first = min((x for x in ids if x is not None), default=None)
        revisit = len(ids) > 1 and i != first
        found.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(found, key=repr)


def archived(pages, **sizes):
    folder = fresh_folder(pages.sparkSession, "warc")
    index = warc.write_archives(pages, folder, **sizes)
    return index, folder, warc.read_archives(index, folder)


def result(read):
    rows = read.select(F.col("page_id").cast("bigint"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("bigint"))
    return sorted([tuple(r) for r in rows.collect()], key=repr)


def random_rows(n):
    random.seed(n)
    bodies = [f"<html>{random.random()}" + "word " * random.randint(0, 400) for _ in range(max(1, n // 3))]
    return [(i, f"http://h{i % 3}.example/{i}", random.choice(bodies) if i % 2 else "copy " * 30) for i in range(n)]


ODD = [
    (1, None, None),
    (2, "http://a.example/ä\r\nX: y z", ""),
    (3, "", "short"),
    (4, "u", "short"),
    (None, "u", "é" * 100),
    (7, "u", "é" * 100),
    (6, "u", "é" * 100),
    (6, "u", "é" * 100),
    (None, None, "only without ids " * 20),
    (None, None, "only without ids " * 20),
    (9, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 9),
    (10, "u", "long " * 1_500_000),
    (-5, "u", "long " * 1_500_000),
]


@pytest.mark.parametrize("rows", [random_rows(300), ODD, random_rows(1)], ids=["random", "odd", "one"])
def test_records_read_back(spark, rows):
    index, _, read = archived(pages_of(spark, rows))
    assert result(read) == brute(rows)
    assert index.count() == len(rows)
    payloads = {(r["payload_digest"], None if r["payload"] is None else bytes(r["payload"])) for r in read.collect()}
    assert {p for _, p in payloads if p is not None} == {(h or "").encode() for _, _, h in rows}


def test_heavy_payloads_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(warc, "HEAVY_SHARE", 20)
    rows = random_rows(200)
    assert result(archived(pages_of(spark, rows))[2]) == brute(rows)


def test_empty_table(spark):
    index, _, read = archived(pages_of(spark, []))
    assert index.count() == read.count() == 0
    assert read.columns == [f.split()[0] for f in warc.READ.split(", ")]


def test_archives_are_self_contained_and_open_at_any_record(spark):
    index, folder, read = archived(pages_of(spark, random_rows(300)), archive_bytes=3000, sample_bytes=20_000)
    assert index.select("archive").distinct().count() > 3
    assert result(read) == brute(random_rows(300))
    files, base = warc._filesystem(folder)
    for row in index.collect()[::20]:
        with files.open_input_stream(f"{base}/{row['archive']}", compression=None) as source:
            content = source.read()
        assert int.from_bytes(content[:4], "little") == warc.DICTIONARY_MAGIC
        head = warc.open_dictionary(io.BytesIO(content))
        record = warc.record_at(content[row["start"] : row["start"] + row["length"]], head)
        assert record["warc-record-id"] == row["record_id"] and record["warc-type"] == row["record_type"]
        with pytest.raises(zstandard.ZstdError):
            zstandard.ZstdDecompressor().decompress(content[row["start"] : row["start"] + row["length"]])


def test_dictionary_helps_short_records():
    records = [warc.page_record(str(i), "u", f"<html><nav>{'menu ' * 20}</nav>{i * 7919}".encode(), "0" * 64, None, False, "d")[1] for i in range(400)]
    with_dictionary, plain = io.BytesIO(), zstandard.ZstdCompressor(level=warc.LEVEL)
    with_dictionary.close = lambda: None
    writer = warc.ArchiveWriter(with_dictionary)
    for r in records:
        writer.add(r, ())
    writer.close()
    assert len(with_dictionary.getvalue()) < sum(len(plain.compress(r)) for r in records) / 2


def test_a_damaged_archive_is_an_error(spark):
    _, folder, _ = archived(pages_of(spark, random_rows(30)))
    record = warc.page_record("1", "u", b"x" * 200, "0" * 64, None, False, "d")[1]
    parsed = warc._parsed(io.BufferedReader(io.BytesIO(record)))
    with pytest.raises(ValueError, match="not the one archived"):
        warc.page_fields("a", parsed)
    with pytest.raises(ValueError, match="inside a record"):
        warc._parsed(io.BufferedReader(io.BytesIO(record[:-30])))
    with pytest.raises(ValueError, match="dictionary"):
        warc.open_dictionary(io.BytesIO(b"\x28\xb5\x2f\xfd" + b"0" * 20))
