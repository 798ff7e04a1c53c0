"""Discard rules, tariff split, restart sessions and sequences on micro tables; sources and sinks."""

from datetime import datetime as T

import pytest
from pyspark.sql import functions as F

from ampereflow import values as V
from ampereflow.operators import cleaning as C
from ampereflow.sources import landing as L
from ampereflow.streaming import streams

RAW = "order_id string, user_id string, station_id string, status string, start_time string, end_time string, kwh string, meter_kwh string, ef string, sf string, flat_kwh string, end_reason string"


def raw(spark, **changes):
    row = {"order_id": "1", "user_id": "7.0", "station_id": "station-1", "status": "支付完成", "start_time": "2025-01-01 10:00:00", "end_time": "2025-01-01 11:00:00", "kwh": "10", "meter_kwh": "10", "ef": "5", "sf": "1", "flat_kwh": "10", "end_reason": "用户拔枪"} | changes
    return spark.createDataFrame([tuple(row[c.split()[0]] for c in RAW.split(", "))], RAW)


@pytest.mark.parametrize(("changes", "code"), [
    ({}, 0), ({"status": "废弃", "kwh": "900"}, 1), ({"kwh": "900"}, 2), ({"meter_kwh": "801"}, 3), ({"ef": "501"}, 4), ({"sf": "501"}, 5), ({"ef": "450", "sf": "450"}, 6), ({"kwh": "-1"}, 7), ({"ef": "41"}, 8), ({"meter_kwh": "-1"}, 9),
    ({"end_time": "2025-01-01 09:00:00"}, 10), ({"kwh": "0"}, 11), ({"kwh": "0", "ef": "0", "sf": "0"}, 12), ({"meter_kwh": "11"}, 13), ({"flat_kwh": "0"}, 14), ({"end_time": "2025-01-02 05:00:00"}, 15), ({"start_time": "0000-00-00 00:00:00"}, 16), ({"start_time": "2019-12-31 23:59:59", "end_time": "2020-01-01 00:10:00"}, 17),
])
def test_discard_rules(spark, changes, code):
    row = C.discard_rules(L.typed_cast(L.canonicalize(raw(spark, **changes)))).first()
    assert row["discard_code"] == code and bool(row["discard_reason"]) == bool(code)


def tou(spark, start, end, kwh):
    df = spark.createDataFrame([(T.fromisoformat(start), T.fromisoformat(end), kwh)], "start_ts timestamp, end_ts timestamp, energy_kwh double")
    r = C.tou_allocate(df).first()
    return r["peak_kwh"], r["flat_kwh"], r["valley_kwh"]


def test_tariffs(spark):
    assert tou(spark, "2025-06-30 10:00:00", "2025-06-30 12:00:00", 88.0) == (44, 44, 0)
    assert tou(spark, "2025-07-01 10:00:00", "2025-07-01 12:00:00", 88.0) == (0, 44, 44)
    assert tou(spark, "2025-06-30 23:00:00", "2025-07-01 01:00:00", 10.0) == (0, 5, 5)
    assert tou(spark, "2025-06-30 23:00:00", "2025-06-30 23:00:00", 10.0) == (0, 0, 0)


def orders(spark, rows):
    full = [(str(k), u, s, T.fromisoformat(f"2025-01-01 {a}"), T.fromisoformat(f"2025-01-01 {b}"), e, why, d) for k, (u, s, a, b, e, why, d) in enumerate(rows)]
    df = spark.createDataFrame(full, "order_id string, user_id string, station_id string, start_ts timestamp, end_ts timestamp, energy_kwh double, end_reason string, used_discount boolean")
    return df.withColumns({"peak_kwh": F.lit(0.0), "flat_kwh": F.col("energy_kwh"), "valley_kwh": F.lit(0.0), "paid_electric": F.lit(1.0), "paid_service": F.lit(1.0), "paid_amount": F.lit(2.0), "discount_amount": F.lit(0.0), "end_reason_class": F.lit("x")})


def test_restart_sessions(spark):
    rows = [("a", "1", "08:00:00", "08:10:00", 1.0, "", False), ("a", "1", "08:09:59", "08:20:00", 1.0, "", False), ("a", "1", "08:20:00", "08:30:00", 1.0, "", False), ("a", "1", "08:40:00", "08:50:00", 1.0, "", False), ("a", "1", "09:00:01", "09:10:00", 1.0, "", False)]
    got = [r["session_no"] for r in C.restart_sessions(orders(spark, rows)).orderBy("order_id").collect()]
    assert got == [1, 2, 2, 2, 3]
    rows = [("a", "1", "08:00:00", "08:05:00", 1.0, "", False), ("a", "2", "08:06:00", "08:07:00", 1.0, "", False), ("a", "1", "08:08:00", "08:09:00", 1.0, "", False), (None, "1", "08:00:00", "08:01:00", 1.0, "", False), (None, "1", "08:02:00", "08:03:00", 1.0, "", False)]
    assert C.merge_restart_orders(C.restart_sessions(orders(spark, rows))).count() == 5


def test_restart_merge(spark):
    rows = [("a", "1", "08:00:00", "08:10:00", 2.0, "x", False), ("a", "1", "08:12:00", "08:20:00", 3.0, "y", True), ("a", "1", "08:21:00", "08:30:00", 0.0, "x", False)]
    r = C.merge_restart_orders(C.restart_sessions(orders(spark, rows))).collect()
    assert len(r) == 1
    r = r[0]
    assert (r["energy_kwh"], r["end_reason"], r["used_discount"], r["raw_orders"], r["duration_min"], r["order_id"]) == (5.0, "x；y", True, 3, 30.0, "0")


def test_sequence(spark):
    rows = [("a", "1", "08:00:00", "08:10:00", 1.0, "", False), ("a", "1", "09:30:00", "09:40:00", 1.0, "", False), ("a", None, "10:00:00", "10:10:00", 1.0, "", False), ("a", "2", "11:00:00", "11:10:00", 1.0, "", False)]
    got = [(r["user_seq"], r["gap_h"], r["reuse_station"]) for r in C.order_sequence(orders(spark, rows)).orderBy("order_id").collect()]
    assert got == [(1, None, "首次充电"), (2, 1.5, "是"), (3, 0.5, "站点缺失"), (4, 1.0, "站点缺失")]


def test_sources_and_sinks(spark, tmp_path):
    rows = raw(spark).unionAll(raw(spark, order_id="2"))
    L.export_csv(rows, str(tmp_path / "csv"))
    back = L.csv_tolerant_scan(spark, str(tmp_path / "csv"), rows.columns)
    assert sorted(r["order_id"] for r in back.collect()) == ["1", "2"]
    for k in (1, 2):
        rows.where(f"order_id = '{k}'").write.parquet(str(tmp_path / f"land/y26_m{k}"))
    scan = L.landing_scan(spark, str(tmp_path / "land"))
    assert scan.count() == 2 and "source_table" in scan.columns
    L.sink(rows.withColumn("m", F.lit(1)), str(tmp_path / "out"), partition_by=("m",))
    L.sink(rows.withColumn("m", F.lit(2)), str(tmp_path / "out"), "overwrite", ("m",))
    assert L.read_merged(spark, str(tmp_path / "out")).count() == 4
    meta = L.snapshot_meta(rows)
    assert L.validate_snapshot(rows, meta).first()["n_rows"] == 2
    with pytest.raises(Exception, match="snapshot differs"):
        L.validate_snapshot(rows.limit(1), meta).collect()
    with pytest.raises(ValueError, match="nope"):
        L.require_columns(rows, ["nope"])
    two = L.canonicalize(spark.createDataFrame([(None, "b"), ("a", "b")], "EF string, `电费` string"))
    assert [r["ef"] for r in two.collect()] == ["b", "a"]


def test_clean_stream_equals_batch(spark, tmp_path):
    first, second = raw(spark), raw(spark, order_id="2", status="废弃")
    first.write.parquet(str(tmp_path / "in/a"))
    schema = first.schema
    path = str(tmp_path / "in/*")
    for step in (first, second):
        if step is second:
            second.write.parquet(str(tmp_path / "in/b"))
        streams.incremental_clean_stream(streams.order_stream(spark, path, schema), str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    batch = C.discard_rules(L.typed_cast(L.canonicalize(first.unionAll(second))))
    assert spark.read.parquet(str(tmp_path / "out/main")).count() == batch.where("discard_code = 0").count() == 1
    assert spark.read.parquet(str(tmp_path / "out/discarded")).count() == 1


def test_stream_aggregates_equal_batch(spark, tmp_path):
    rows = [("a", "1", "08:00:00", "08:10:00", 2.0, "x", False), ("a", "1", "08:50:00", "09:20:00", 3.0, "y", True), ("b", "1", "10:21:00", "10:30:00", 1.0, "x", False)]
    orders(spark, rows).select("user_id", "start_ts", "energy_kwh").write.parquet(str(tmp_path / "o"))
    stream = lambda: spark.readStream.schema("user_id string, start_ts timestamp, energy_kwh double").parquet(str(tmp_path / "o"))
    hours = streams.run_to_table(streams.hourly_orders_stream(stream()), "hours", str(tmp_path / "c1"))
    assert sorted((r["hour_start"].hour, r["orders"]) for r in hours.collect()) == [(8, 2), (10, 1)]
    days = streams.run_to_table(streams.user_daily_stream(stream()), "days", str(tmp_path / "c2"))
    assert sorted((r["user_id"], r["orders"], float(r["kwh"])) for r in days.collect()) == [("a", 2, 5.0), ("b", 1, 1.0)]


def test_sequence_of_rows_without_user(spark):
    """Rows without a user are windows per day; the result is that of one window over all of them."""
    rows = [(f"{k:03}", None if k % 3 else "a", str(k % 2), T(2025, 1 + k % 2, 1 + (k * 7) % 9, k % 24)) for k in range(80)] + [("x", None, "1", None), ("y", None, None, T(2025, 1, 1))]
    df = spark.createDataFrame(rows, "order_id string, user_id string, station_id string, start_ts timestamp").withColumn("end_ts", F.expr("start_ts + INTERVAL 5 MINUTES"))
    got = {r["order_id"]: r for r in C.order_sequence(df).collect()}
    for user in ("a", None):
        mine = sorted((r for r in rows if r[1] == user), key=lambda r: (r[3] is not None, r[3] or T.min, r[0]))
        months = {}
        for n, r in enumerate(mine, 1):
            before = mine[n - 2] if n > 1 else None
            month = months[r[3] and r[3].month] = months.get(r[3] and r[3].month, 0) + 1
            gap = None if before is None or before[3] is None or r[3] is None else round((r[3] - before[3]).total_seconds() / 3600, 3)
            reuse = "首次充电" if n == 1 else "站点缺失" if before[2] is None or r[2] is None else "是" if before[2] == r[2] else "否"
            x = got[r[0]]
            assert (x["user_seq"], x["user_month_seq"], x["gap_h"], x["reuse_station"]) == (n, month, gap, reuse)
    sessions = [r["session_no"] for r in C.restart_sessions(df).where("user_id IS NULL").collect()]
    assert sorted(sessions) == list(range(1, len(sessions) + 1))


def test_jdbc_round_trip(spark):
    url = "jdbc:derby:memory:orders;create=true"
    rows = spark.range(100).selectExpr("id AS k", "CAST(id * 1.5 AS DOUBLE) AS kwh")
    L.jdbc_write(rows, url, "charge", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    L.jdbc_write(rows.where("k < 5"), url, "charge", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    back = L.jdbc_read(spark, url, "charge", "k", 0, 100, 4, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert back.rdd.getNumPartitions() == 4 and back.count() == 105 and back.agg(F.sum("kwh")).first()[0] == 1.5 * (99 * 50 + 10)


def test_station_dims_by_file_order(spark):
    rows = spark.createDataFrame([("1", "b", "x", "y", 0), ("station-1", "a", "x", "y", 1), ("2", "c", "x", "y", 2)], "station_id string, station_name string, station_type string, place string, row long")
    names = lambda df: sorted(r["station_name"] for r in df.collect())
    assert names(C.load_station_dims(rows)) == ["a", "c"] and names(C.load_station_dims(rows, ("row",))) == ["b", "c"]


def test_field_stats_of_an_empty_table(spark):
    df = spark.createDataFrame([("a", 1), (None, 1)], "x string, y int")
    got = lambda d: sorted(tuple(r) for r in C.field_stats(d, ["x", "y"]).collect())
    assert got(df) == [("x", 1, 0.5, 1), ("y", 0, 0.0, 1)] and got(df.limit(0)) == [("x", 0, 0.0, 0), ("y", 0, 0.0, 0)]


def heavy_orders(spark, n=4000, days=40):
    """Half of the rows are of one user, who charges around midnight too, so that restarts run over the ends of days."""
    rows = spark.range(n).withColumn("k", F.col("id"))
    # every second order is u0's, some minutes after its last one; the others are spread over a hundred users
    start = F.expr(f"TIMESTAMP '2025-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST(CASE WHEN k % 2 = 0 THEN k DIV 2 * {days * 86400 * 2 // n} ELSE (k * 7919) % {days * 86400} END AS DECIMAL(18,6)))")
    return rows.select(
        F.format_string("%06d", "k").alias("order_id"), F.when(F.col("k") % 2 == 0, "u0").when(F.col("k") % 19 == 1, None).otherwise(F.concat(F.lit("u"), (1 + F.col("k") % 100).cast("string"))).alias("user_id"),
        (F.col("k") % 16 < 14).cast("string").alias("station_id"), start.alias("start_ts"), (start + F.expr("make_dt_interval(0, 0, CAST(20 + k % 17 AS INT), 0)")).alias("end_ts"),
    )


def test_heavy_user_is_parted_by_day(spark):
    """One user has half of the rows: the same numbers, gaps and sessions, also of sessions over midnight, and no large task."""
    df = heavy_orders(spark)
    heavy = C.heavy_users(df, least=1000)
    assert [r["_who"] for r in heavy.collect()] == ["=u0"]
    for by_source in (False, True):
        rules = V.CleanRules(partition_by_source=by_source)
        rows = df.withColumn("source_table", F.when(F.col("order_id") % 3 == 0, "a"))
        some = C.heavy_users(rows, rules, least=500)
        assert some.count() == 2 if by_source else 1
        for of in (C.order_sequence, C.restart_sessions):
            plain = {tuple(r) for r in of(rows, rules).collect()}
            assert plain == {tuple(r) for r in of(rows, rules, heavy=some).select(*of(rows, rules).columns).collect()}
            assert len(plain) == df.count()
    numbered = C.restart_sessions(df, heavy=heavy)
    nights = numbered.where("user_id = 'u0'").groupBy("session_no").agg(F.count_distinct(F.to_date("start_ts")).alias("d")).where("d > 1").count()
    assert nights > 0
    # rows of each part of the windows: none above twice the median of the days
    parts = [r["n"] for r in C._parts(df, V.CleanRules(), heavy, ("start_ts", "order_id"), ("station_id",), F.month("start_ts")).groupBy("_who", "_part").agg(F.count("*").alias("n")).where("_who = '=u0'").collect()]
    assert len(parts) == 40 and max(parts) <= 2 * sorted(parts)[20]
    plan = C.restart_sessions(df, heavy=heavy)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan


def test_no_user_is_heavy_below_the_bounds(spark):
    df = heavy_orders(spark, 400, 4)
    assert C.heavy_users(df).count() == 0
    assert C.heavy_users(df, least=1, share=0.9).count() == 0
    assert C.heavy_users(df.limit(0), least=1).count() == 0
    assert C.restart_sessions(df, heavy=C.heavy_users(df)).count() == 400
