"""Readers, writers and catalog lookups on files in a temporary folder."""

import datetime as dt
import decimal
import glob
import json
import os
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from revloom.operators.changes import change_set
from revloom.plans import field_catalog, mirror, snapshots
from revloom.sources import catalog, keyed, readers, writers


def test_json_with_request_parameters_in_the_path(spark, tmp_path, rows):
    folder = tmp_path / "acme" / "Job Runs" / "2024"
    folder.mkdir(parents=True)
    (folder / "part.json").write_text(json.dumps({"envid": "e1", "data": {"Jan": 3, "Feb": None}}, indent=1))
    df = readers.read_json_with_path(
        spark, str(tmp_path / "*" / "*" / "*"), "envid string, data map<string,bigint>", r"/([^/]+)/([^/]+)/(\d{4})/[^/]+$", ["portal_id", "activity", "year"]
    )
    assert rows(df.drop("data")) == [("e1", "acme", "Job Runs", "2024")]


def test_csv_report_and_range(spark, tmp_path, rows):
    (tmp_path / "r.csv").write_text("Supplier,Amount\nA,1.5\nB,\n")
    report = readers.read_csv_report(spark, str(tmp_path / "r.csv"), "Supplier string, Amount double", "2024-01-02 03:00:00")
    assert rows(report.select("Supplier", "Amount", F.col("now").cast("string"))) == [("A", 1.5, "2024-01-01 22:00:00"), ("B", None, "2024-01-01 22:00:00")]
    (tmp_path / "s.csv").write_text("OrderDate,New Forecast\n2024-01-01,5\n,7\n")
    assert readers.read_range(spark, str(tmp_path / "s.csv"), "OrderDate date, `New Forecast` double", "OrderDate").count() == 1


def test_object_scan(spark, rows):
    df = spark.createDataFrame([("1", 10.0, "EUR", "x"), ("2", 4.0, "GBP", "y")], "Id string, `Amount.x` double, CurrencyIsoCode string, skip string")
    rates = spark.createDataFrame([("EUR", 2.0)], "IsoCode string, ConversionRate double")
    fields = [("Id", "id"), ("Amount.x", "currency"), ("CurrencyIsoCode", "picklist")]
    out = readers.read_object(df, fields, rates=rates)
    assert set(out.columns) == {"Id", "Amount_x", "CurrencyIsoCode", "Amount_x_Converted"}
    assert rows(out.select("Id", "Amount_x_Converted")) == [("1", 5.0), ("2", None)]


def test_query_and_files(spark, tmp_path, rows):
    writers.overwrite(spark.range(3), str(tmp_path / "t"))
    df = readers.read_files(spark, str(tmp_path / "t"))
    assert rows(readers.query(spark, "SELECT max(id) AS m FROM {t}", t=df)) == [(2,)]


def test_appends(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    assert writers.append_if_any(None, path) is False and writers.append_if_any(spark.range(0), path) is False
    assert writers.append_if_any(spark.range(2), path) is True
    writers.append(spark.range(1), path)
    assert rows(spark.read.parquet(path)) == [(0,), (0,), (1,)]
    day = str(tmp_path / "d")
    writers.append_day(spark.range(2), day, "2024-01-01")
    writers.append_day(spark.range(1), day, "2024-01-02")
    writers.append_day(spark.range(3), day, "2024-01-02")  # a rerun replaces its day
    assert spark.read.parquet(day).groupBy("load_date").count().count() == 2 and spark.read.parquet(day).count() == 5
    writers.append_stamped(spark.range(1), str(tmp_path / "s"), "2024-01-01 00:00:00")
    assert spark.read.parquet(str(tmp_path / "s")).columns == ["id", "now"]


def test_mirror_scope(spark, tmp_path):
    every = ["orders", "audit_log", "x_sanitized"]
    as_of = dt.date(2024, 1, 10)
    assert catalog.tables_to_copy(every, None, as_of) == every
    assert catalog.tables_to_copy(every, dt.datetime(2024, 1, 3), as_of) == every
    assert catalog.tables_to_copy(every, dt.datetime(2024, 1, 3, 1), as_of) == ["orders", "x_sanitized"]
    written = []
    done = mirror.copy_tables(
        every, lambda n: spark.range(2).withColumn("t", F.lit(n)),
        str(tmp_path / "a"), [lambda n, df: written.append((n, df.count()))], dt.datetime(2024, 1, 9), as_of,
    )
    assert done == ["orders", "x_sanitized"] and written == [("orders", 2), ("x_sanitized", 2)]
    assert spark.read.parquet(str(tmp_path / "a" / "orders")).count() == 2


def test_cleaned_copies(spark, rows):
    df = spark.createDataFrame([("2024-01-05 10:00:00", 1)], "`Last Activity Date` string, `x.y` int")
    assert rows(mirror.activity_dates(df)) == [(dt.date(2024, 1, 5), 1)]
    assert mirror.cleaned(df).columns == ["Last_Activity_Date", "x_y"]


def test_catalog(spark, rows):
    tables = spark.createDataFrame([("Opportunity_2", 2), ("Account_1", 1), ("Opportunity_1", 1)], "table_name string, creation_time int")
    assert [r[0] for r in catalog.tables_matching(tables, "^Opportunity_").collect()] == ["Opportunity_1", "Opportunity_2"]
    meta = spark.createDataFrame([("audit_log", 86400000), ("other", 0)], "table_id string, last_modified_time long")
    assert catalog.last_modified(meta, "audit_log") == dt.datetime(1970, 1, 2)
    assert catalog.last_modified(meta, "none") is None
    spark.range(1).createOrReplaceTempView("opportunity_tmp")
    assert catalog.list_tables(spark, "default", "^opportunity_") == ["opportunity_tmp"]


def test_field_catalog(spark):
    described = spark.createDataFrame(
        [("double", [{"v": "x" * 6000}], "Amount", "amount")], "type string, picklistValues array<map<string,string>>, label string, name string"
    )
    out = field_catalog.run({"RecordType": described, "Lead": described})
    assert out["Lead"].columns == ["name", "label", "type", "_picklistValues"]
    lengths = {n: df.select(F.length("_picklistValues")).first()[0] for n, df in out.items()}
    assert lengths["RecordType"] > 6000 and lengths["Lead"] > 6000
    assert catalog.describe(described).columns == ["name", "label", "type", "nullable"]


def test_jdbc_needs_a_driver(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        readers.read_sql_table(spark, "jdbc:nosuch://h/db", "t", key="id", partitions=4)
    with pytest.raises(Exception, match="(?i)driver"):
        writers.write_sql_table(spark.range(1), "jdbc:nosuch://h/db", "t")


def test_jdbc_ranges():
    assert readers.split_options("id", 5, 104, 8) == {"partitionColumn": "id", "lowerBound": "5", "upperBound": "105", "numPartitions": "8"}
    assert readers.split_options("id", 7, 8, 8)["numPartitions"] == "2"
    assert readers.split_options("id", None, None, 8) == {}


def test_write_all_and_tables(spark, tmp_path, rows):
    writers.write_all({"b": spark.range(1), "a": spark.range(2)}, str(tmp_path / "o"), last="b")
    assert spark.read.parquet(str(tmp_path / "o" / "a")).count() == 2 and spark.read.parquet(str(tmp_path / "o" / "b")).count() == 1


def array_file(path, records, between=",", ends=("[", "]")):
    path.write_text(ends[0] + between.join(records) + ends[1], encoding="utf-8")
    return str(path)


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "997")
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("between", [",", " ,\n  ", ",\r\n"])
def test_one_array_is_read_by_many_tasks(spark, tmp_path, small_splits, between):
    draw = random.Random(4)
    odd = ["}", "{", '"', "\\", "},{", "[", "]", ",", "é", "你", " ", "x", "\n", '\\"}']
    docs = [{"id": i, "note": "".join(draw.choice(odd) for _ in range(draw.randrange(40))), "data": {"tags": ["}{", draw.choice(odd)] * draw.randrange(4), "deep": {"n": i * 2}}} for i in range(400)]
    path = array_file(tmp_path / "a.json", [json.dumps(d, ensure_ascii=bool(i % 2), indent=2 if i % 3 == 0 else None) for i, d in enumerate(docs)], between, ("﻿ [\n", "\n]\n"))
    schema = "id INT, note STRING, data STRUCT<tags: ARRAY<STRING>, deep: STRUCT<n: INT>>"
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 20
    got = readers.read_json_array(spark, path, schema).collect()
    assert sorted(r.number for r in got) == list(range(400))
    assert [r.record.asDict(True) for r in sorted(got, key=lambda r: r.number)] == docs


def test_arrays_of_several_files_and_broken_ones(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, records in {"a": ['{"id": 1}', '{"id": 2}'], "b": [], "c": ['{"id": 3, "x": {"y": "}"}}', '{"id": 4']}.items():
        array_file(tmp_path / "in" / f"{name}.json", records)
    got = readers.read_json_array(spark, str(tmp_path / "in"), "id INT")
    assert sorted((r.file[-6:], r.number, r.record.id) for r in got.collect() if r.file[-6:] != "c.json" or r.number == 0) == [("a.json", 0, 1), ("a.json", 1, 2), ("c.json", 0, 3)]
    assert got.count() == 4, "the record that does not end is there too"


def test_range_predicates():
    day = dt.date(2024, 1, 5)
    assert readers.range_predicates("k", []) == readers.range_predicates("k", ["a"]) == ["1 = 1"]
    assert readers.range_predicates("k", ["a", "o'b", "o'b", "z"]) == ["k < 'o''b' OR k IS NULL", "k >= 'o''b' AND k < 'z'", "k >= 'z'"]
    assert readers.range_predicates("d", [day, dt.date(2024, 2, 1)]) == ["d < '2024-02-01' OR d IS NULL", "d >= '2024-02-01'"]
    assert readers.range_predicates("t", [None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 3, 4, 5, 6)])[1] == "t >= '2024-01-02 03:04:05.000006'"
    assert readers.range_predicates("n", [1, decimal.Decimal("2.50")]) == ["n < 2.50 OR n IS NULL", "n >= 2.50"]


def test_predicates_part_a_table():
    """Every row is in one range and ranges are even, as a database counts them."""
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT i, CASE WHEN i % 10 = 0 THEN NULL ELSE 'k''' || (i * 7919 % 1000) END AS k, DATE '2024-01-01' + CAST(i % 90 AS INTEGER) AS d FROM range(3000) r(i)")
    for column in ("k", "d"):
        borders = [r[0] for r in con.execute(readers.quantile_query("t", column, 6) + " ORDER BY border").fetchall()]
        parts = [con.execute(f"SELECT i FROM t WHERE {p}").fetchall() for p in readers.range_predicates(column, borders)]
        assert len(parts) == 6 and sorted(i for p in parts for (i,) in p) == list(range(3000))
        assert max(map(len, parts)) < 1000


def test_quantiles_reach_the_reader(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(type(spark.read), "jdbc", lambda self, url, table, **kw: asked.append((url, table, kw)))
    monkeypatch.setattr(type(spark.read), "load", lambda self, *a: spark.createDataFrame([("a",), ("m",)], "border string"))
    readers.read_sql_table(spark, "jdbc:x:y", "t", quantiles="name", partitions=2, user="u")
    assert asked == [("jdbc:x:y", "t", {"predicates": ["name < 'm' OR name IS NULL", "name >= 'm'"], "properties": {"fetchsize": "10000", "user": "u"}})]


def files_read(df):
    """Files that the scans of the executed plan have read."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    leaves = execution.executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.length()))


def test_keyed_table_touches_what_a_batch_meets(spark, tmp_path):
    path = str(tmp_path / "t")
    before = spark.range(2000).select("id", (F.col("id") * 2).alias("v"))
    keyed.write(before, path, ["id"], 64)
    files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*/*.parquet")}
    assert len(glob.glob(f"{path}/key_part=*")) == 64
    after = before.where("id NOT IN (5, 7)").withColumn("v", F.when(F.col("id") == 11, -1).otherwise(F.col("v"))).union(spark.createDataFrame([(9001, 1)], "id bigint, v bigint"))
    changes = change_set(keyed.read(spark, path).drop(keyed.PART), after, "id")
    numbers = keyed.apply(changes, path, "id", 64)
    assert 1 <= len(numbers) <= 4
    kept = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*/*.parquet")}
    assert all(kept.get(f) == t for f, t in files.items() if int(re.search(r"key_part=(\d+)", f)[1]) not in numbers)
    assert keyed.read(spark, path).drop(keyed.PART).exceptAll(after).isEmpty() and keyed.read(spark, path).count() == 1999
    assert files_read(keyed.read(spark, path, numbers[:1])) == 1 and files_read(keyed.read(spark, path)) == len(kept)


def test_keyed_partition_without_rows_goes(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(3).withColumn("v", F.lit(1))
    keyed.write(rows, path, ["id"], 8)
    assert keyed.apply(change_set(rows, rows, "id"), path, "id", 8) == []
    keyed.apply(change_set(rows, rows.limit(0), "id"), path, "id", 8)
    assert glob.glob(f"{path}/key_part=*") == [] and keyed.read(spark, str(tmp_path / "none")) is None


def test_captures_of_a_schema_are_one_scan(spark, tmp_path):
    """Two thousand captures of three schemas, the types of the first of them."""
    kinds = {0: "id BIGINT, stage STRING", 1: "id BIGINT, amount INT", 2: "id BIGINT, amount DOUBLE, stage STRING"}
    listed, expected = [], set()
    for k, ddl in kinds.items():
        names = [f.split()[0] for f in ddl.split(", ")]
        rows = spark.range(0, 4002).where(F.col("id") % 3 == k).select(
            (F.col("id") * 10).alias("id"), (F.col("id") % 7).cast("int" if k == 1 else "double").alias("amount"), F.concat(F.lit("s"), F.col("id") % 5).alias("stage"), F.floor(F.col("id") / 6).alias("c"))
        rows.select(*names, "c").repartition(8, "c").write.partitionBy("c").parquet(f"{tmp_path}/k{k}")
        for c in range(667):
            at = dt.datetime(2020, 1, 1) + dt.timedelta(hours=3 * c + k)
            listed.append((f"Opportunity_{k}_{c}", at, f"{tmp_path}/k{k}/c={c}" + "/" * (c % 2), ddl))
        expected |= {(i * 10, i % 7 if k else None, f"s{i % 5}" if k != 1 else None, dt.datetime(2020, 1, 1) + dt.timedelta(hours=3 * (i // 6) + k)) for i in range(4002) if i % 3 == k}
    captures = spark.createDataFrame(listed, "table_name string, creation_time timestamp, path string, schema string")
    assert len(listed) == 2001
    out = snapshots.load(spark, captures, None, "^Opportunity_")
    assert dict(out.dtypes) == {"id": "bigint", "stage": "string", "amount": "int", "snapshot_time": "timestamp"}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 3
    got = {(r.id, r.amount, r.stage, r.snapshot_time) for r in out.collect()}
    assert got == expected
    few = captures.where("table_name IN ('Opportunity_0_1', 'Opportunity_2_5')").drop("schema")
    assert snapshots.load(spark, few, captures.where("table_name = 'Opportunity_0_1'").withColumnRenamed("creation_time", "snapshot_time")).count() == 2
    assert snapshots.load(spark, few.limit(0), None) is None


def test_one_array_file_is_written_and_read_in_bounded_parts(spark, tmp_path, monkeypatch):
    """The task of the one file passes records on without sorting them; the windows over a file are cut by rows, wherever a cut falls."""
    monkeypatch.setattr(readers, "CUT_PIECES", 3)
    records = [{"id": n, "s": 'a "}" {' + "x\\" * (n % 3), "o": {"p": [n, {"q": "},{"}]}} for n in range(200)]
    texts = spark.createDataFrame([(json.dumps(r),) for r in records], "value string").repartition(5)
    writers.write_json_array(texts, str(tmp_path / "one"))
    files = glob.glob(f"{tmp_path}/one/part-*")
    assert len(files) == 1 and sorted(json.loads(open(files[0]).read()), key=lambda r: r["id"]) == records
    back = readers.read_json_array(spark, str(tmp_path / "one"), "id INT, s STRING, o STRUCT<p: ARRAY<STRING>>")
    got = back.select("number", "record.id", "record.s").collect()
    assert sorted(r.number for r in got) == list(range(200)) and {(r.id, r.s) for r in got} == {(r["id"], r["s"]) for r in records}
    writers.write_json_array(texts.limit(0), str(tmp_path / "none"))
    assert readers.read_json_array(spark, str(tmp_path / "none"), "id INT").count() == 0


def test_a_change_set_is_worked_out_once(spark, tmp_path):
    place = f"{tmp_path}/table"
    keyed.write(spark.range(100).selectExpr("id", "id AS v"), place, ["id"], 8)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    changes = spark.range(90, 110).selectExpr("id", "IF(id < 100, 'update', 'insert') AS action", "id * 2 AS v")
    assert keyed.apply(changes.mapInArrow(counted, changes.schema), place, "id", 8) and seen.value == 20
    assert sorted((r.id, r.v) for r in keyed.read(spark, place).collect()) == [(n, n if n < 90 else 2 * n) for n in range(110)]
