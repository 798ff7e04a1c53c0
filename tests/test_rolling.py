"""Windows, runs, states, lists, preferences on micro tables; the two rolling forms; the segment checks as data test."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ampereflow import values as V
from ampereflow.operators import features as P
from ampereflow.operators import reports as R
from ampereflow.operators import rolling as G
from ampereflow.plans import orders as O
from ampereflow.plans import registry

SF = "/root/testdata/sf0.001"


def snaps(spark, rows):
    full = [(u, date(2025, 1, 1) + timedelta(k - 90), date(2025, 1, 1) + timedelta(k), t) for u, k, t in rows]
    return spark.createDataFrame(full, "user_id string, win_start date, win_end date, rfm_type string")


def test_runs_pass_over_absence_and_states(spark):
    H, N = V.HV_ACTIVE, V.GENERAL
    rows = [("gap", 0, H), ("gap", 2, H), ("ret", 0, H), ("ret", 1, N), ("ret", 2, H), ("exit", 0, H), ("exit", 2, N), ("sil", 0, H), ("sil", 1, N), ("none", 2, N)]
    s = snaps(spark, rows)
    periods = G.type_periods(s)
    assert [(r["n_windows"], r["prev_type"], r["next_type"]) for r in periods.where("user_id = 'gap'").collect()] == [(2, "无", "无")]
    states = {r["user_id"]: r["hv_state"] for r in G.four_state(G.high_value_trajectory(periods), s).collect()}
    assert states == {"gap": V.STABLE, "ret": V.RETURNING, "exit": V.EXITED, "sil": V.SILENT}


def test_window_grid(spark):
    daily = spark.createDataFrame([("a", date(2025, 1, 1)), ("a", date(2025, 12, 31))], "user_id string, order_date date")
    got = sorted(r["win_end"] for r in G.window_end_dates(daily, V.Windows(90, 7, 180)).collect())
    top = date(2025, 12, 31)
    assert got[0] == top - timedelta(90) and got[-1] == top and got[-2] == top - timedelta(7) and len(got) == 14


def test_both_rolling_forms(spark):
    daily = O.daily(spark, SF).where("user_id < 'U3'").persist()
    spec = V.Windows(60, 7, 120)
    a, b = (f(daily, spec).select("win_end", "user_id", "n_orders", "span_days", "rfm_type") for f in (G.rolling_rfm_snapshots, G.rolling_rfm_by_range))
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def day_orders(spark, rows):
    full = [(str(k), u, datetime(2025, 1, 1, 12) + timedelta(d), "公共场站", r) for k, (u, d, r) in enumerate(rows)]
    return spark.createDataFrame(full, "order_id string, user_id string, start_ts timestamp, station_category string, reason_text string")


def test_returning_new_and_abnormal(spark):
    rows = [("g30", 70, ""), ("g30", 100, ""), ("g31", 69, ""), ("g31", 100, ""), ("new", 100, ""), ("new", 94, ""), ("old", 93, ""), ("bad", 99, "支付异常"), ("bad", 99, "支付异常"), ("bad", 98, "启动失败"), ("fine", 99, "异常但正常结束")]
    base = G.list_base(day_orders(spark, rows))
    assert [r["user_id"] for r in G.returning_users(base).collect()] == ["g31"]
    assert {r["user_id"] for r in G.new_users(base).collect()} == {"new", "bad", "fine"}
    got = G.recent_abnormal(base).collect()
    assert [(r["user_id"], r["abnormal_orders"], r["reason_detail"], r["main_reason"]) for r in got] == [("bad", 3, "支付异常(2)；启动失败(1)", "支付异常")]


def test_previous_charge_on_the_last_day_of_a_period(spark):
    ret = spark.createDataFrame([("a", date(2025, 1, 10), date(2025, 3, 1))], "user_id string, prev_date date, return_date date")
    periods = spark.createDataFrame([("a", V.HV_ACTIVE, date(2025, 1, 1), date(2025, 1, 10))], "user_id string, rfm_type string, seg_start date, seg_end date")
    states = spark.createDataFrame([("a", V.EXITED)], "user_id string, hv_state string")
    r = G.returning_hv_flags(ret, periods, states).first()
    assert r["was_hv"] and r["ever_hv"] and r["hv_state_before"] == V.EXITED


def test_top_value_tie(spark):
    base = spark.createDataFrame([("a", "2"), ("a", "1"), ("a", ""), ("a", None)], "user_id string, station_id string")
    r = P.station_concentration(base).first()
    assert (r["top_station"], r["station2"], r["station3"], r["station_share1"], r["station_min3"]) == ("1", "2", None, 0.5, 0.0)


def test_sample_floor(spark):
    f = spark.createDataFrame([("a", 1, datetime(2025, 1, 1), datetime(2025, 1, 1), *[0] * len(P.FLAGS))], "user_id string, n_orders long, first_ts timestamp, last_ts timestamp, " + ", ".join(f"n_{x} long" for x in P.FLAGS))
    r = P.user_ratio_features(f, f.agg(F.max("last_ts").alias("sample_max"))).first()
    assert (r["span_days"], r["days_per_order"], r["days_since_last"]) == (14, 14.0, 0)


def test_share_rounding(spark):
    got = R.share_rounding(spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "k string, n long"), []).orderBy("k").collect()
    assert [r["percent"] for r in got] == [33.4, 33.3, 33.3]


def test_sessions_keep_energy(spark):
    main, sessions = O.main(spark, SF), O.sessions(spark, SF)
    total = lambda df: round(df.agg(F.sum(F.col("energy_kwh").cast("decimal(18,3)"))).first()[0], 3)
    assert sessions.count() <= main.count() and total(main) == total(sessions)
    assert sessions.where("abs(peak_kwh + flat_kwh + valley_kwh - energy_kwh) > 0.02").count() == 0


def test_segments_cover_every_user_once(spark):
    seg, x = O.final(spark, SF)
    assert seg.count() == x["main"].count() == seg.select("user_id").distinct().count()
    spark.catalog.clearCache()


def test_valley_density_counts_all_rows(spark):
    rows = spark.range(260_000).select(F.col("id").alias("order_id"), F.when(F.col("id") < 250_000, V.CATEGORIES[0]).otherwise(V.CATEGORIES[1]).alias("station_category"), (F.col("id") % 4 / 4).alias("valley_share"))
    got = {(r["station_category"], r["bin"]): (r["n"], r["density"]) for r in R.valley_density(rows).collect()}
    want = {(V.CATEGORIES[k], b): (n, 12.5) for k, n in enumerate((62_500, 2_500)) for b in (0, 12, 25, 37)}
    assert got == want
    got = {(r["station_category"], r["bin"]): (r["n"], r["density"]) for r in R.valley_density(rows, total=True).collect()}
    assert got == want | {(V.TOTAL, b): (65_000, 12.5) for b in (0, 12, 25, 37)}


def test_gaps_reach_back_before_the_window(spark):
    day = lambda k: datetime(2025, 1, 1) + timedelta(k)
    rows = [("1", "u", "s", day(0), "普通"), ("2", "u", "s", day(100), "普通"), ("3", "u", "b", day(110), V.BUS), ("4", "u", "s", day(120), "普通"), ("5", "w", "s", day(150), "普通")]
    df = spark.createDataFrame(rows, "order_id string, user_id string, station_id string, start_ts timestamp, station_category string")
    more = {c: F.lit("x") for c in ("charger_id", "charge_method", "channel", "end_reason_class", "abnormal_reason")} | {c: F.lit(1.0) for c in ("energy_kwh", "paid_amount", "discount_amount", "valley_share")}
    df = df.withColumns(more | {"end_ts": F.expr("start_ts + INTERVAL 1 HOUR"), "is_valid": F.lit(V.YES)})
    base = P.order_behavior_base(P.recent_window(P.exclude_category(P.sequenced(df)), 90))
    got = {r["order_id"]: (r["gap_h"], r["reused_station"]) for r in base.collect()}
    assert got == {"2": (2400.0, True), "4": (240.0, False), "5": (None, False)}
    wide = {r["user_id"]: r["n_gaps"] for r in P.user_wide(df).collect()}
    assert wide == {"u": 2, "w": 0}


def test_share_rounding_and_top_values(spark):
    df = spark.createDataFrame([("g", k, n) for k, n in enumerate((1, 1, 1))] + [("h", 0, 7)], "g string, k int, n long")
    got = {(r["g"], r["k"]): r["percent"] for r in R.share_rounding(df, ["g"]).collect()}
    assert got == {("g", 0): 33.4, ("g", 1): 33.3, ("g", 2): 33.3, ("h", 0): 100.0}
    values = spark.createDataFrame([(v,) for v in "aaabbbccd"] + [(None,)] * 2, "v string")
    assert sorted((r["value"], r["orders"]) for r in R.top_plus_other(values, "v", 2).collect()) == [("a", 3), ("b", 3), ("其他", 5)]
    assert [r["k"] for r in P.ranked_output(df.withColumnRenamed("g", "user_id"), ("-n", "k")).collect()] == [0, 0, 1, 2]


def test_legacy_states(spark):
    old = next(iter(V.LEGACY_STATES))
    rows = spark.createDataFrame([(old,), (V.STABLE,), (None,)], "s string").select(G.legacy_state_alias(F.col("s")).alias("s"))
    assert [r["s"] for r in rows.collect()] == [V.LEGACY_STATES[old], V.STABLE, None]


def test_sample_is_the_smallest_draws(spark):
    import hashlib

    rows = [("a", str(n)) for n in range(3000)] + [("b", str(n)) for n in range(40)] + [(None, str(n)) for n in range(300)] + [("c", "same")] * 500 + [("d", None)] * 5
    df = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "g string, k string, n long").repartition(7)
    draw = lambda k: int(hashlib.md5(":".join([*([k] if k is not None else []), "42"]).encode()).hexdigest()[:15], 16)
    for most in (1, 100, 299, 5000):
        got = R.bounded_random_sample(df, "g", "k", most).collect()
        assert len({r["n"] for r in got}) == len(got) and df.columns == list(got[0].asDict())
        for g in ("a", "b", None, "c", "d"):
            want = sorted((k for h, k in rows if h == g), key=lambda k: (draw(k), k or ""))[:most]
            assert sorted(str(r["k"]) for r in got if r["g"] == g) == sorted(map(str, want))
    assert R.bounded_random_sample(df.limit(0), "g", "k", 3).collect() == []


def test_coupon_rules(spark):
    row = lambda code, days, level="低", state="", valley="低", bad=False: (f"{code}{days}{level}{state}", code, days, state, level, valley, bad)
    rows = [row("05", 10, state=V.EXITED), row("05", 70, state=V.EXITED), row("05", 70, "高", V.EXITED), row("09", 40), row("09", 9, "高"), row("11", 3), row("11", 20), row("11", 100, "高"), row("11", 100, state=V.EXITED), row("01", 1, valley="高", bad=True), row("08", 12, None), row("99", 12)]
    df = spark.createDataFrame(rows, "user_id string, segment_code string, days_since_last int, hv_state string, coupon_level string, valley_level string, is_abnormal boolean")
    got = {r["user_id"]: (r["tier"], r["coupon"], r["amount"], r["days"], r["send_order"]) for r in G.coupon_assignment(df).collect()}
    assert list(map(got.get, (r[0] for r in rows))) == [
        (1, "满减券", 15, 15, 1), (4, "满减券", 15, 30, 3), (4, "折扣券", 10, 30, 3), (3, "甲方券包", 20, 30, 7), (1, "阶梯任务券", 2, 7, 7), (None, None, None, None, None), (2, "甲方券包", 10, 15, 6),
        (5, "折扣券", 30, 30, 6), (5, "满减券", 15, 30, 6), (None, "新手成长任务券", 5, 7, None), (1, "谷段时长折扣券", 2, 7, 5), (1, None, None, None, None),
    ]
    own = G.coupon_rules(spark).where("segment_code <> '11'")
    assert G.coupon_assignment(df, own).where("segment_code = '11' AND coupon IS NOT NULL").count() == 0


def test_windows_by_parts_shuffle_user_days_only(spark):
    rows = [(f"U{k % 7}", f"2024-01-{1 + k % 28:02d} 08:00:00", float(k % 50), "") for k in range(200)]
    orders = spark.createDataFrame(rows, "user_id string, start_ts string, energy_kwh double, station_category string").withColumn("start_ts", F.col("start_ts").cast("timestamp"))
    daily = spark.createDataFrame(G.user_daily(orders).collect(), G.user_daily(orders).schema)
    spec = V.Windows(start="2024-01-05")
    plain, parted = G.rolling_rfm_snapshots(daily, spec), G.rolling_rfm_snapshots(daily, spec, parts=3)
    assert plain.count() and sorted(plain.collect()) == sorted(parted.collect())
    plan = G.type_periods(parted)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1
    periods = G.type_periods(plain)
    states = lambda windows: sorted(G.four_state(G.high_value_trajectory(periods), windows).collect())
    assert states(plain) == states(G.last_windows(periods)) and sorted(G.sliding_overview(plain).collect()) == sorted(G.sliding_overview(plain, periods).collect())


@pytest.mark.parametrize("name", ["final_segment", "recent_overview", "sliding_overview", "silent_history_detail", "silent_list", "legacy_hv_classes"])
def test_segment_queries_read_the_orders_once(spark, name):
    """What they return reads written orders, user-days and periods; the tables behind them are not read again by each branch."""
    read = {f.split("/")[-1] for f in registry.QUERIES[name](spark, "/root/testdata/sf0.001").inputFiles()}
    assert read and not read & {"lineitem.parquet", "orders.parquet"}


@pytest.mark.parametrize("spec", [V.Windows(), V.Windows(days=30, step=7, horizon=120), V.Windows(days=10, step=3, horizon=25), V.Windows(start="2024-02-03"), V.Windows(days=5, step=1, horizon=200)])
def test_periods_without_windows(spark, spec):
    """The same periods as from a row for each user and window, with fewer rows between: days that enter and leave on one date, gaps
    longer than a window, users who stop early or start late, energy on both sides of every limit."""
    rng = random.Random(spec.days * 10 + spec.step)
    rows = []
    for u in range(120):
        at, k = rng.randrange(0, 220), 0
        while at < 240 and k < 150:
            rows += [(f"U{u}", f"{date(2023, 9, 1) + timedelta(days=at)} {rng.randrange(24):02d}:15:00", rng.choice((5.0, 12.5, 20.0, 31.0, 40.0, 55.5)) if u % 3 else 48.0, "") for _ in range(rng.choice((1, 1, 1, 3)))]
            at, k = at + rng.choice(((1, 2), (3, 5, 8), (spec.days, 1, spec.days + 1, spec.days - 1), (25, 40, 61), (7, 14, 30))[u % 5]), k + 1
    orders = spark.createDataFrame(rows, "user_id string, start_ts string, energy_kwh double, station_category string").withColumn("start_ts", F.col("start_ts").cast("timestamp"))
    daily = spark.createDataFrame(G.user_daily(orders).collect(), G.user_daily(orders).schema)
    want = G.type_periods(G.rolling_rfm_snapshots(daily, spec))
    got = G.window_periods(daily, spec)
    assert got.dtypes == want.dtypes and want.count() > 100
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) == sorted(map(tuple, G.window_periods(daily, spec, parts=3).collect()))
    assert G.window_periods(daily.limit(0), spec).collect() == []


def test_only_named_columns_of_orders_are_computed(spark):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    orders = O.day(spark, SF)
    total = "sum(cast((l_extendedprice"  # of the discount, which user-days do not read
    assert total in plan(G.user_daily(orders)) and total not in plan(O.daily(spark, SF))
    assert O.day(spark, SF, O.DAYS).exceptAll(orders.select(*O.DAYS)).count() == 0 == orders.select(*O.DAYS).exceptAll(O.day(spark, SF, O.DAYS)).count()


@pytest.mark.parametrize("name", ["segment_overview", "core7_segments", "targeting_form"])
def test_queries_on_segments_write_what_they_need(spark, name, monkeypatch):
    """Neither the main table is written with all of its columns, nor, for the targeting form, any window or list."""
    seen, write = {}, O.written
    monkeypatch.setattr(O, "written", lambda df, label: (seen.update({label: df.columns}), write(df, label))[1])
    registry.QUERIES[name](spark, SF)
    assert "main" not in seen and "charger_id" not in seen["day"] and (name != "targeting_form" or set(seen) == {"day"})
