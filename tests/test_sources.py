"""Sources told by listings and footers; CSV files with unlike headers."""

import os

from pyspark.sql import functions as F

from ampereflow.sources import landing as L
from ampereflow.sources import manifest as M


def land(spark, root, name, rows, ddl="order_id string, kwh double"):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("overwrite").parquet(f"{root}/{name}")


def names(df):
    return sorted({r["source_table"] for r in df.select("source_table").collect()})


def test_manifest_reads_only_new_and_changed_sources(spark, tmp_path):
    root, at = str(tmp_path / "land"), str(tmp_path / "manifest")
    for k in (1, 2, 3):
        land(spark, root, f"y26_m{k}", [(f"{k}{n}", float(n)) for n in range(k)])
    schema = spark.read.parquet(f"{root}/y26_m1").schema
    rows, told = M.import_new(spark, root, at, schema, 1, "folder")
    assert names(rows) == ["y26_m1", "y26_m2", "y26_m3"] and rows.count() == 6
    assert {r["source_table"]: r["n_rows"] for r in told.collect()} == {"y26_m1": 1, "y26_m2": 2, "y26_m3": 3}
    M.record(told, at, 1)
    rows, told = M.import_new(spark, root, at, schema, 2, "folder")
    assert rows.count() == 0 and told.count() == 0 and rows.columns == ["source_table", "order_id", "kwh"]

    land(spark, root, "y26_m4", [("40", 1.0)])  # new
    land(spark, root, "y26_m2", [("20", 1.0), ("21", 1.0), ("22", 1.0)])  # other rows
    land(spark, root, "y26_m3", [(f"3{n}", 7.0) for n in range(3)])  # written again, as many rows
    listing, known = M.list_sources(spark, root, "folder", "*.parquet"), M.read_manifest(spark, at)
    assert names(M.new_sources(listing, known)) == ["y26_m4"]
    assert names(M.touched_sources(listing, known)) == ["y26_m2", "y26_m3", "y26_m4"]
    rows, told = M.import_new(spark, root, at, schema, 2, "folder")
    assert names(rows) == ["y26_m2", "y26_m4"] and rows.count() == 4
    assert sorted({f.split("/")[-2] for f in rows.inputFiles()}) == ["y26_m2", "y26_m4"]  # the scan lists nothing else
    M.record(told, at, 2)
    M.record(told, at, 2)  # a repeated run
    assert M.import_new(spark, root, at, schema, 3, "folder")[0].count() == 0
    land(spark, root, "y26_m1", [("10", 1.0, 1)], "order_id string, kwh double, more int")  # other columns
    assert names(M.import_new(spark, root, at, schema, 3, "folder")[0]) == ["y26_m1"]


def test_counts_read_no_column(spark, tmp_path):
    land(spark, str(tmp_path), "a", [("1", 1.0)] * 1000)
    files = M.list_sources(spark, str(tmp_path), "folder", "*.parquet")
    assert [(r["source_table"], r["n_rows"]) for r in M.facts(spark, files, "folder").collect()] == [("a", 1000)]
    plan = M.facts(spark, files, "folder")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<>" in plan and "kwh" not in plan


def test_names_are_made_once_a_file(spark, tmp_path):
    for k in ("y26_m1", "y26_m2"):
        land(spark, str(tmp_path / "land"), k, [("1", 1.0)] * 1000)
    root = str(tmp_path / "land")
    files = M.list_sources(spark, root, "folder", "*.parquet")
    rows = M.read_sources(spark, files, spark.read.parquet(f"{root}/y26_m1").schema, by="folder")
    scan = L.landing_scan(spark, root, pathGlobFilter="*.parquet")
    assert rows.columns == ["source_table", "order_id", "kwh"] and {r["source_table"]: r["count"] for r in rows.groupBy("source_table").count().collect()} == {"y26_m1": 1000, "y26_m2": 1000}
    assert scan.columns == ["source_table", "order_id", "kwh", "source_file"] and scan.where("source_table LIKE 'part_00000%'").count() == 2000
    for df in (rows, scan, M.facts(spark, files, "folder")):
        plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        made = [n for n, line in enumerate(plan) if "regexp_extract" in line]
        assert made and not any(line.strip(" :+-").startswith("Relation") and "parquet" in line for n in made for line in plan[n + 1 : n + 2])  # not in the step that reads the rows


def test_csv_files_of_unlike_headers(spark, tmp_path):
    files = {
        "a.csv": "﻿order_id,kwh,note\n1,2.5,\"two\nlines\"\n2,3.5,x\nbad\n",
        "b.csv": "note,order_id,kwh,extra\nn,3,4.5,e\n\"q \"\"q\"\"\",4,5.5,\n1,2,3,4,5\n",
        "c.csv": "order_id,kwh,note\n5,6.5,y\n",
        "d.csv": "order_id,order_id,ORDER_ID\n6,7,8\n",
        "e.csv": "",
        "only_header.csv": "kwh,other\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    got = L.csv_tolerant_scan(spark, str(tmp_path))
    assert sorted(got.columns) == ["extra", "kwh", "note", "order_id", "other"]
    rows = {r["order_id"]: (r["kwh"], r["note"], r["extra"], r["other"]) for r in got.collect()}
    assert rows == {"1": ("2.5", "two\nlines", None, None), "2": ("3.5", "x", None, None), "3": ("4.5", "n", "e", None), "4": ("5.5", 'q "q"', None, None), "5": ("6.5", "y", None, None), "6": (None, None, None, None)}
    assert sorted(r["order_id"] for r in got.select("order_id").collect()) == list("123456")  # the same rows whatever is selected
    bad = {os.path.basename(r["source_file"]): r["bad_lines"] for r in L.csv_bad_lines(spark, str(tmp_path)).collect()}
    assert bad == {"a.csv": 1, "b.csv": 1, "c.csv": 0, "d.csv": 0}
    some = L.csv_tolerant_scan(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], ["kwh", "extra", "nowhere"])
    assert some.columns == ["kwh", "extra", "nowhere"] and some.agg(F.sum(F.col("kwh").cast("double"))).first()[0] == 16.0 and some.where("nowhere IS NOT NULL").count() == 0
    assert L.csv_tolerant_scan(spark, str(tmp_path / "e.csv"), ["kwh"]).collect() == []


def test_jdbc_bounds_and_writes_once(spark):
    url, options = "jdbc:derby:memory:once;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    typed = options | {"createTableColumnTypes": "name VARCHAR(100)"}
    rows = spark.range(200).selectExpr("id AS k", "CAST(id % 7 AS DOUBLE) AS kwh", "CAST(id AS STRING) AS name")
    assert L.jdbc_write_once(rows, url, "charge", "first", **typed)
    assert not L.jdbc_write_once(rows, url, "charge", "first", **typed)  # the run again
    assert L.jdbc_write_once(rows.where("k < 5").union(rows.where("k < 5")), url, "charge", "second", **typed)  # equal rows of one run are rows of their own
    back = L.jdbc_read_all(spark, url, "charge", "k", 4, **options)
    assert back.rdd.getNumPartitions() == 4 and back.count() == 210 and back.agg(F.max("k")).first()[0] == 199
    sizes = back.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 70
    assert L.jdbc_write_once(rows.where("k < 3"), url, "charge", "third", overwrite=True, **typed)
    assert sorted(r["name"] for r in L.jdbc_read_all(spark, url, "charge", "k", 4, **options).collect()) == ["0", "1", "2"]
    assert L.jdbc_write_once(rows.limit(0), url, "charge", "fourth", overwrite=True, **typed)
    assert L.jdbc_read_all(spark, url, "charge", "k", 4, **options).collect() == []
