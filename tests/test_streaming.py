"""The landing stream: each document once, reruns add nothing."""

import json

from pyspark.sql import types as T

from revloom.plans import telemetry
from revloom.sources import keyed
from revloom.streaming.landing import load_documents
from test_sources import files_read

SCHEMA = T.StructType([
    T.StructField("version", T.StringType()), T.StructField("creationDate", T.LongType()),
    T.StructField("interfaces", T.ArrayType(T.StructType([T.StructField("type", T.StringType())]))),
])


def land(folder, name, ids, bad=()):
    lines = [{"id": i, "creationDate": "0", "data": json.dumps({"version": str(i), "creationDate": i, "interfaces": [{"type": "a"}, {"type": "b"}]})} for i in ids]
    lines += [{"id": i, "creationDate": "0", "data": "{x"} for i in bad]
    (folder / name).write_text("\n".join(json.dumps(x) for x in lines))


def test_documents_load_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    target = str(tmp_path / "target")

    def load(checkpoint="c1", name="first"):
        load_documents(spark, str(landing), target, str(tmp_path / checkpoint), SCHEMA, load_name=name)
        read = lambda n: sorted(r[0] for r in spark.read.parquet(f"{target}/{n}").select(telemetry.KEY).collect())
        return read("product_statistics"), read("interfaces"), read("unreadable")

    land(landing, "a.json", [1, 2, 2], bad=[9])
    assert load() == ([1, 2], [1, 1, 2, 2], [9])
    land(landing, "b.json", [2, 3])
    assert load() == ([1, 2, 3], [1, 1, 2, 2, 3, 3], [9])
    assert load() == ([1, 2, 3], [1, 1, 2, 2, 3, 3], [9])
    # a lost checkpoint: everything is read again, nothing but the unreadable rows is written again
    assert load("c2", "second")[:2] == ([1, 2, 3], [1, 1, 2, 2, 3, 3])


def test_a_batch_reads_the_ids_that_it_may_meet(spark, tmp_path, monkeypatch):
    """The id table lies in hash partitions; a batch of two ids reads two of them, however long the history."""
    landing = tmp_path / "landing"
    landing.mkdir()
    seen = []
    read = keyed.read
    monkeypatch.setattr(keyed, "read", lambda spark, path, numbers=None: seen.append(read(spark, path, numbers)) or seen[-1])

    def load():
        load_documents(spark, str(landing), str(tmp_path / "t"), str(tmp_path / "c"), SCHEMA, load_name="x")

    land(landing, "a.json", range(100))
    load()
    land(landing, "b.json", [5, 500])
    load()
    assert seen[0] is None and files_read(seen[1]) <= 4 < 20 < files_read(read(spark, f"{tmp_path}/t/product_statistics"))
    assert sorted(r[0] for r in read(spark, f"{tmp_path}/t/product_statistics").select(telemetry.KEY).collect()) == [*range(100), 500]
