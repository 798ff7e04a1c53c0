"""Tables kept by streams against the batch result, over restarts, repeated batches and late rows."""

import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ampereflow.operators import cleaning as C
from ampereflow.operators import rolling as G
from ampereflow.plans import orders as O
from ampereflow.streaming import feeds, streams

SF = "/root/testdata/sf0.001"


def rows_of(df):
    cols = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(cols).collect()), key=str)


def test_sessions_of_touched_users_equal_batch(spark, tmp_path):
    out = str(tmp_path / "out")
    start = F.expr("TIMESTAMP '2025-01-01' + make_interval(0, 0, 0, 0, 0, 0, (CAST(order_id AS INT) * 7919) % 60000)")
    main = O.main(spark, SF).withColumns({"start_ts": start, "user_id": F.expr("IF(user_id IS NULL, NULL, CAST(CAST(user_id AS INT) % 20 AS STRING))"), "station_id": F.lit("1")})
    main = main.withColumn("end_ts", F.expr("start_ts + INTERVAL 5 MINUTES")).persist()
    whole = C.merge_restart_orders(C.restart_sessions(main)).drop("session_no")
    assert whole.where("raw_orders > 1").count() > 3 and main.where("user_id IS NULL").count() > 5
    part = F.pmod(F.xxhash64("order_id"), F.lit(3))
    stamp = lambda: {d: max(os.stat(f"{out}/sessions/{d}/{f}").st_mtime_ns for f in os.listdir(f"{out}/sessions/{d}")) for d in os.listdir(f"{out}/sessions") if d.startswith("bucket")}
    for n in range(3):
        feeds.add_to_sessions(main.where(part == n), out, n, buckets=8)
    feeds.add_to_sessions(main.where(part == 2), out, 2, buckets=8)  # the last batch again
    table = spark.read.schema(whole.schema).parquet(f"{out}/sessions").drop("bucket")
    assert rows_of(table) == rows_of(whole)
    before = stamp()
    one = main.where("user_id IS NOT NULL").limit(1).withColumns({"order_id": F.lit("later"), "start_ts": F.expr("start_ts + INTERVAL 1000 DAYS"), "end_ts": F.expr("end_ts + INTERVAL 1000 DAYS")}).persist()
    touched = feeds.add_to_sessions(one, out, 3, buckets=8)
    after = stamp()
    assert len(touched) == 1 and {d for d in after if after[d] != before.get(d)} == {f"bucket={touched[0]}"}
    assert table.sparkSession.read.schema(whole.schema).parquet(f"{out}/sessions").count() == whole.count() + 1
    assert feeds.add_to_sessions(main.limit(0), out, 4, buckets=8) == []
    main.unpersist(), one.unpersist()


def test_user_days_after_a_restart_feed_the_windows(spark, tmp_path):
    day = O.day(spark, SF).where("user_id < 'U3'").persist()
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    stream = lambda: streams.order_stream(spark, f"{src}/*", day.schema, 1)
    for n in range(4):  # two runs of the stream, of two files each
        day.where(F.pmod(F.xxhash64("order_id"), F.lit(4)) == n).coalesce(1).write.parquet(f"{src}/{n}")
        if n % 2:
            feeds.user_day_feed(stream(), out, ckpt, span="month").awaitTermination()
    fed, batch = feeds.user_days(spark, out), G.user_daily(day)
    assert rows_of(fed) == rows_of(batch)
    assert rows_of(G.rolling_rfm_snapshots(fed)) == rows_of(G.rolling_rfm_snapshots(batch))
    log = feeds.late_rows(spark, out).collect()
    assert len(log) == 4 and all(r["late"] == 0 for r in log)
    feeds.add_to_sums(day.where("false"), out, 4, "day", ("user_id",), {"orders": (F.count("*"), "sum"), "kwh": (F.sum(F.col("energy_kwh").cast("decimal(18,3)")), "sum"), "last_ts": (F.max("start_ts"), "max")}, None, span="month")
    assert rows_of(feeds.user_days(spark, out)) == rows_of(batch)
    day.unpersist()


def test_late_rows_are_counted(spark, tmp_path):
    out, t0 = str(tmp_path / "out"), datetime(2025, 1, 1)
    batches = [[0, 30, 60, 600], [100, 470, 479, 480, 481, 601, 700], [0, 540, 570, 579, 580, 10_000], [], [9_000, 9_900]]  # minutes
    latest, table, want = None, {}, []
    for n, minutes in enumerate(batches):
        mark = None if latest is None else latest - 120
        late = [m for m in minutes if mark is not None and m // 60 * 60 + 60 <= mark]
        for m in minutes:
            if m not in late:
                table[m // 60] = table.get(m // 60, 0) + 1
        want.append((n, len(minutes), len(late)))
        latest = max([*minutes, *([latest] if latest is not None else [])])
        df = spark.createDataFrame([(t0 + timedelta(minutes=m),) for m in minutes] + [(None,)], "start_ts timestamp")
        for _ in range(1 + (n == 2)):  # the third batch runs twice
            feeds.add_to_sums(df, out, n, "hour", (), {"orders": (F.count("*"), "sum")}, "2 hours")
    assert sum(w[2] for w in want) > 4
    assert sorted((r["batch"], r["rows"], r["late"]) for r in feeds.late_rows(spark, out).collect()) == want
    got = spark.read.parquet(f"{out}/sums").collect()
    assert {int((r["hour"] - t0).total_seconds()) // 3600: r["orders"] for r in got} == table
