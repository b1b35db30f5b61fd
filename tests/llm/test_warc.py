"""Web archives: round trips, member by member, and revisits."""

import gzip
import hashlib
import io
import json
import zlib

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from revloom.llm import warc

PAGES = "page_id long, url string, html string, file string, digest int"


def expected(rows):
    """Digest columns per page, by first page of each payload of 100 bytes or more."""
    out, first = [], {}
    for page_id, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        payload = (html or "").encode()
        digest = hashlib.sha256(payload).hexdigest()
        target = first.setdefault(digest, (page_id,)) if len(payload) >= 100 else None
        again = target is not None and digest in seen(out)
        out.append((page_id, len(payload), digest, "revisit" if again else "response", target[0] if again else None))
    return out


def seen(out):
    return {r[2] for r in out}


def test_round_trip(spark):
    long = "<p>payload</p>" * 20
    rows = [(5, "http://a/", long), (3, "http://b/ x\r\ny", long), (9, None, long), (None, "http://c/", long), (1, "u", None), (2, "u", ""), (4, "é", "short"), (6, "u", "short"),
            (7, "u", "big é " * 300_000), (8, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 9), (10, "u", "x" * 99), (11, "u", "x" * 99), (12, "u", "y" * 100), (12, "u", "y" * 100)]
    df = spark.createDataFrame([(*r, "f", 0) for r in rows], PAGES).repartition(3)
    place, archives = warc.archived(df)
    got = [tuple(r) for r in warc.read_back(place, archives).collect()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(got, key=key) == sorted(expected(rows), key=key)

    system, path = fs.FileSystem.from_uri(place)
    for name in [r["archive"] for r in archives.collect()]:
        with system.open_input_file(f"{path}/{name}") as f:
            data = f.read()
        whole = gzip.decompress(data)
        with system.open_input_file(f"{path}/{name}.index") as f:
            index = [json.loads(x) for x in f.read().splitlines()]
        # members stand one behind another and are, in order, the records of the whole
        assert [e["offset"] for e in index] == [sum(e["length"] for e in index[:k]) for k in range(len(index))] and sum(e["length"] for e in index) == len(data)
        assert b"".join(zlib.decompress(data[e["offset"] : e["offset"] + e["length"]], 31) for e in index) == whole
        assert list(warc.records_of(io.BytesIO(data))) == [zlib.decompress(data[e["offset"] : e["offset"] + e["length"]], 31) for e in index]


def test_a_cut_stream_raises():
    data = gzip.compress(warc.record("response", 1, "u", 3, "d", b"abc"))
    assert [warc.parsed(x)[2] for x in warc.records_of(io.BytesIO(data))] == [b"abc"]
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(data[:-12])))


def test_no_pages(spark):
    place, archives = warc.archived(spark.createDataFrame([], PAGES))
    assert archives.collect() == [] and warc.read_back(place, archives).collect() == []


def test_a_task_per_archive(spark):
    """However few bytes their names have, archives are normalised and read by many tasks."""
    rows = [(i, f"http://{i}/", f"<p>page {i}</p>" * 20, "f", 0) for i in range(240)]
    place, archives = warc.archived(spark.createDataFrame(rows, PAGES).repartition(24))
    assert archives.count() == 24
    back = warc.read_back(place, archives)
    assert back.rdd.getNumPartitions() == 24 and back.count() == 240
    # Spark samples the names for its ranges, so a few archives may share a task
    assert back.select(F.spark_partition_id()).distinct().count() > 12
    system, path = fs.FileSystem.from_uri(f"{place}/archives")
    assert sum(f.path.endswith(".parquet") for f in system.get_file_info(fs.FileSelector(path))) > 12
