"""Rolling RFM windows, type periods, high-value trajectories, and the lists and segments built on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import values as V
from ..functions import scalars as S
from .cleaning import metrics_long
from .features import exclude_category, rfm_scores


def user_daily(orders: DataFrame) -> DataFrame:
    """(user_id, order_date, orders, kwh, last_ts): made before any window, so windows read days instead of orders."""
    rows = exclude_category(orders).where((F.trim(F.coalesce("user_id", F.lit(""))) != "") & F.col("start_ts").isNotNull())
    return rows.groupBy("user_id", F.to_date("start_ts").alias("order_date")).agg(F.count("*").alias("orders"), F.sum(F.coalesce("energy_kwh", F.lit(0.0)).cast("decimal(18,3)")).alias("kwh"), F.max("start_ts").alias("last_ts"))


def _span(daily: DataFrame, spec: V.Windows) -> DataFrame:
    """One row: the first possible end date (low) and the last (hi); none where there are no days between them."""
    horizon = max(spec.horizon, spec.days)
    low = F.lit(spec.start).cast("date") if spec.start else F.greatest(F.date_sub("hi", horizon - spec.days), F.col("lo"))
    return daily.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi")).where("hi IS NOT NULL").withColumn("low", low).where("low <= hi").select("low", "hi")


def window_end_dates(daily: DataFrame, spec: V.Windows = V.Windows()) -> DataFrame:
    """End dates from the last day backwards by step; the first possible end always belongs to them."""
    dates = F.array_distinct(F.concat(F.sequence("hi", "low", F.expr(f"INTERVAL '-{spec.step}' DAY")), F.array("low")))
    return _span(daily, spec).select(F.explode(dates).alias("win_end"))


def rolling_rfm_snapshots(daily: DataFrame, spec: V.Windows = V.Windows(), parts: int | None = None) -> DataFrame:
    """Per end date and user: totals of the last days, scores and type. The end dates (one for each step of the horizon, whatever the
    number of rows) are broadcast; a user-day meets at most days / step and one of them, summed before the shuffle. With parts the
    user-days are dealt by user into so many parts before they meet the windows: then neither the sums nor what follows by user
    (type_periods) shuffles rows of windows; a task holds the windows of its part, so parts has to grow with the user-days."""
    ends = window_end_dates(daily, spec)
    joined = (daily.repartition(parts, "user_id") if parts else daily).join(F.broadcast(ends), F.col("order_date").between(F.date_sub("win_end", spec.days - 1), F.col("win_end")))
    return _scored(joined.groupBy("win_end", "user_id").agg(F.sum("orders").alias("n_orders"), F.max("last_ts").alias("last_ts"), F.min("order_date").alias("first_date"), F.sum("kwh").alias("kwh")), spec)


def rolling_rfm_by_range(daily: DataFrame, spec: V.Windows = V.Windows()) -> DataFrame:
    """The same by range frames over day numbers: for long windows, where each day would meet many end dates."""
    ends = window_end_dates(daily, spec)
    users = daily.select("user_id").distinct().crossJoin(F.broadcast(ends)).select("user_id", F.col("win_end").alias("order_date"), F.lit(None).cast("long").alias("orders"), F.lit(None).cast("decimal(18,3)").alias("kwh"), F.lit(None).cast("timestamp").alias("last_ts"), F.lit(True).alias("spine"))
    rows = daily.select("user_id", "order_date", "orders", F.col("kwh").cast("decimal(18,3)"), "last_ts", F.lit(False).alias("spine")).unionByName(users).withColumn("day_no", F.unix_date("order_date"))
    w = Window.partitionBy("user_id").orderBy("day_no").rangeBetween(-(spec.days - 1), 0)
    out = rows.select("user_id", F.col("order_date").alias("win_end"), "spine", F.sum("orders").over(w).alias("n_orders"), F.max("last_ts").over(w).alias("last_ts"), F.min(F.when(~F.col("spine"), F.col("order_date"))).over(w).alias("first_date"), F.sum("kwh").over(w).alias("kwh"))
    return _scored(out.where("spine AND n_orders > 0").drop("spine"), spec)


def _scored(sums: DataFrame, spec: V.Windows, *more: str) -> DataFrame:
    span = F.greatest(F.datediff("win_end", "first_date") + 1, F.lit(14))
    out = sums.select(
        F.date_sub("win_end", spec.days - 1).alias("win_start"), "win_end", "user_id", "n_orders", "last_ts", F.datediff("win_end", "last_ts").alias("days_to_end"), span.alias("span_days"),
        F.try_divide(span.cast("double"), F.col("n_orders")).alias("days_per_order"), F.try_divide(F.col("kwh").cast("double"), F.col("n_orders")).alias("avg_kwh"), *more,
    )
    out = rfm_scores(out, "days_to_end")
    return out.withColumn("is_hv_active", F.col("rfm_type") == V.HV_ACTIVE)


def type_periods(snapshots: DataFrame) -> DataFrame:
    """Runs of one type over the windows in which the user is present, with the type before and after (无 at the ends)."""
    return _runs(snapshots.select("user_id", "win_start", "win_end", F.col("win_end").alias("_to"), "rfm_type", F.lit(1).alias("_n")))


def _runs(rows: DataFrame) -> DataFrame:
    """Rows stand for _n windows of one user and type from win_end to _to."""
    w = Window.partitionBy("user_id").orderBy("win_end")
    change = F.coalesce((F.lag("rfm_type").over(w) != F.col("rfm_type")).cast("int"), F.lit(1))
    rows = rows.select("user_id", "win_start", "_to", "rfm_type", "_n", "win_end", change.alias("c")).withColumn("run", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = rows.groupBy("user_id", "run", "rfm_type").agg(F.min("win_start").alias("first_start"), F.max("_to").alias("seg_end"), F.sum("_n").alias("n_windows"))
    v = Window.partitionBy("user_id").orderBy("run")
    return runs.select("user_id", "rfm_type", F.col("first_start").alias("seg_start"), "seg_end", "n_windows", F.coalesce(F.lag("rfm_type").over(v), F.lit(V.NONE)).alias("prev_type"), F.coalesce(F.lead("rfm_type").over(v), F.lit(V.NONE)).alias("next_type"))


def window_periods(daily: DataFrame, spec: V.Windows = V.Windows(), parts: int | None = None) -> DataFrame:
    """type_periods of rolling_rfm_snapshots, made without a row for each window. What a window holds of a user changes only where a
    day enters it or leaves it; between two such dates the type changes only where the days since the last order or the span pass a
    limit of their score. So there is a row for each of these dates and type, however many windows lie between them. Expects user-days
    (user_daily: one row per user and date, kwh as decimal); parts as in rolling_rfm_snapshots."""
    c, user = F.col, Window.partitionBy("user_id")
    days = daily.crossJoin(F.broadcast(_span(daily, spec))).where(c("order_date").between(F.date_sub("low", spec.days - 1), c("hi")))
    days = days.repartition(parts, "user_id") if parts else days
    w = user.orderBy("order_date")
    days = days.withColumns({"_before": F.lag("order_date").over(w), "_after": F.lead("order_date").over(w), "_gone": F.date_add("order_date", spec.days)})
    # the earliest day of the window: a day that enters an empty one, or the day after one that leaves
    enters = F.struct(c("order_date").alias("at"), c("orders").alias("n"), c("kwh").alias("k"), c("last_ts").alias("t"), F.when(c("_before").isNull() | (F.date_add("_before", spec.days) <= c("order_date")), c("order_date")).alias("d"))
    leaves = F.struct(c("_gone").alias("at"), (-c("orders")).alias("n"), (-c("kwh")).alias("k"), F.lit(None).cast("timestamp").alias("t"), F.when(c("_after") <= c("_gone"), c("_after")).alias("d"))
    v = user.orderBy("at", "n")
    sofar = v.rowsBetween(Window.unboundedPreceding, 0)
    rows = days.select("user_id", "low", "hi", F.inline(F.array(enters, leaves))).where("at <= hi")
    rows = rows.select(
        "user_id", "low", "hi", F.greatest("at", "low").alias("_a"), F.least("hi", F.date_sub(F.lead("at").over(v), 1)).alias("_b"),
        F.sum("n").over(sofar).alias("n_orders"), F.sum("k").over(sofar).alias("kwh"), F.last("t", True).over(sofar).alias("last_ts"), F.last("d", True).over(sofar).alias("first_date"),
    ).where("n_orders > 0 AND _a <= _b")
    cuts = [F.date_add("last_ts", d + 1) for d in S.R_LIMITS] + [F.date_add("first_date", F.least(c("n_orders") * d, F.lit(spec.days)).cast("int")) for d in S.F_LIMITS]
    starts = F.array_distinct(F.array_compact(F.array("_a", *[F.when((x > c("_a")) & (x <= c("_b")), x) for x in cuts])))
    rows = _scored(rows.withColumn("win_end", F.explode(starts)), spec, "low", "hi", "_b")
    until = F.least("_b", F.date_sub(F.lead("win_end").over(user.orderBy("win_end")), 1))
    rows = rows.select("user_id", "rfm_type", "low", "hi", "win_end", until.alias("_to"))
    # the end dates between: every step backwards from hi, and low
    whole = lambda x: x.cast("int")
    first = F.when(c("win_end") <= c("low"), c("low")).otherwise(F.date_sub("hi", whole(F.floor(F.datediff("hi", "win_end") / spec.step)) * spec.step))
    last = F.greatest("low", F.date_sub("hi", whole(F.ceil(F.datediff("hi", "_to") / spec.step)) * spec.step))
    rows = rows.select("user_id", "rfm_type", first.alias("win_end"), last.alias("_to")).where("win_end <= _to")
    return _runs(rows.select("user_id", F.date_sub("win_end", spec.days - 1).alias("win_start"), "win_end", "_to", "rfm_type", (F.ceil(F.datediff("_to", "win_end") / spec.step) + 1).alias("_n")))


def high_value_trajectory(periods: DataFrame) -> DataFrame:
    rows = periods.where(F.col("rfm_type") == V.HV_ACTIVE)
    return rows.groupBy("user_id").agg(F.min("seg_start").alias("hv_start"), F.max("seg_end").alias("hv_end"), F.sum("n_windows").alias("hv_windows"), F.count("*").alias("hv_segments"), F.min_by("prev_type", "seg_start").alias("first_prev"), F.max_by("next_type", "seg_end").alias("last_next"))


def four_state(trajectory: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Adds hv_state: not in the last window 沉默; still high 回流 or 稳定; else 历史."""
    last = snapshots.agg(F.max("win_end").alias("_last"))
    there = snapshots.join(F.broadcast(last), F.col("win_end") == F.col("_last")).select("user_id").distinct().withColumn("_there", F.lit(True))
    state = S.chain([(F.col("_there").isNull(), V.SILENT), ((F.col("last_next") == V.NONE) & (F.col("hv_segments") > 1), V.RETURNING), (F.col("last_next") == V.NONE, V.STABLE)], V.EXITED)
    return trajectory.join(there, "user_id", "left").withColumn("hv_state", state).drop("_there")


def last_windows(periods: DataFrame) -> DataFrame:
    """(user_id, win_end) of the last windows of periods: what four_state asks of snapshots, told without them."""
    return periods.select("user_id", F.col("seg_end").alias("win_end"))


def trajectories(daily: DataFrame, spec: V.Windows = V.Windows()) -> DataFrame:
    snapshots = rolling_rfm_snapshots(daily, spec)
    return four_state(high_value_trajectory(type_periods(snapshots)), snapshots)


def sliding_overview(snapshots: DataFrame, periods: DataFrame | None = None) -> DataFrame:
    """periods: those of the snapshots, where the caller has written them."""
    periods = type_periods(snapshots) if periods is None else periods
    states = four_state(high_value_trajectory(periods), last_windows(periods))
    one = snapshots.agg(F.count_distinct("win_end").alias("windows"), F.count("*").alias("snapshot_rows"))
    two = periods.agg(F.count("*").alias("period_rows"), F.count_if(F.col("rfm_type") == V.HV_ACTIVE).alias("hv_periods"))
    three = states.agg(F.count("*").alias("hv_users"), *[F.count_if(F.col("hv_state") == s).alias(n) for n, s in (("stable", V.STABLE), ("returning", V.RETURNING), ("exited", V.EXITED), ("silent", V.SILENT))])
    return metrics_long(one.crossJoin(two).crossJoin(three))


# ---- lists
def list_base(orders: DataFrame, rules: V.ListRules = V.ListRules()) -> DataFrame:
    """Orders of the horizon with their date and the sample's last date; bus stations and blank users left out."""
    rows = exclude_category(orders).where((F.trim(F.coalesce("user_id", F.lit(""))) != "") & F.col("start_ts").isNotNull()).withColumn("d", F.to_date("start_ts"))
    return rows.crossJoin(F.broadcast(rows.agg(F.max("d").alias("end_date")))).where(F.col("d") >= F.date_sub("end_date", rules.horizon - 1))


def new_users(base: DataFrame, rules: V.ListRules = V.ListRules()) -> DataFrame:
    recent = F.col("d") >= F.date_sub("end_date", rules.new_days - 1)
    return base.groupBy("user_id").agg(F.min("start_ts").alias("first_ts"), F.max("start_ts").alias("last_ts"), F.count("*").alias("orders_horizon"), F.count_if(recent).alias("orders_recent"), F.bool_and(recent).alias("_new")).where("_new").drop("_new")


def returning_users(base: DataFrame, rules: V.ListRules = V.ListRules()) -> DataFrame:
    days = base.select("user_id", "d", "end_date").distinct()
    recent = F.col("d") >= F.date_sub("end_date", rules.new_days - 1)
    prev = F.lag("d").over(Window.partitionBy("user_id").orderBy("d"))
    events = days.withColumn("prev_date", prev).withColumn("gap_days", F.datediff("d", "prev_date")).where((F.col("gap_days") > rules.return_gap) & recent).select("user_id", "prev_date", F.col("d").alias("return_date"), "gap_days")
    stats = base.groupBy("user_id").agg(F.count("*").alias("orders_horizon"), F.count_if(~recent).alias("orders_before"), F.count_if(recent).alias("orders_recent"))
    return events.join(stats, "user_id", "left")


def returning_hv_flags(returning: DataFrame, periods: DataFrame, states: DataFrame) -> DataFrame:
    """Was the charge before the gap inside a high-value period (first by start), and was the user ever high-value."""
    hv = periods.where(F.col("rfm_type") == V.HV_ACTIVE).select("user_id", "seg_start", "seg_end")
    hits = returning.select("user_id", "prev_date", "return_date").join(hv, "user_id").where("prev_date BETWEEN seg_start AND seg_end")
    first = hits.groupBy("user_id", "return_date").agg(F.min_by(F.struct("seg_start", "seg_end"), "seg_start").alias("m")).select("user_id", "return_date", "m.seg_start", "m.seg_end")
    out = returning.join(first, ["user_id", "return_date"], "left").join(states.select("user_id", F.col("hv_state").alias("ever_hv_state")), "user_id", "left")
    return out.withColumns({"was_hv": F.col("seg_start").isNotNull(), "ever_hv": F.col("ever_hv_state").isNotNull(), "hv_state_before": F.when(F.col("seg_start").isNotNull(), F.coalesce("ever_hv_state", F.lit(V.YES)))})


def recent_abnormal(base: DataFrame, rules: V.ListRules = V.ListRules(), text: str = "reason_text") -> DataFrame:
    rows = base.where((F.col("d") >= F.date_sub("end_date", rules.abnormal_days - 1)) & S.abnormal_text(F.col(text)))
    reasons = rows.groupBy("user_id", F.col(text).alias("reason")).agg(F.count("*").alias("n"), F.min("start_ts").alias("a"), F.max("start_ts").alias("b"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "reason", "n")))
    out = reasons.groupBy("user_id").agg(F.min("a").alias("first_ts"), F.max("b").alias("last_ts"), F.sum("n").alias("abnormal_orders"), F.count("*").alias("reason_kinds"), order.alias("_r"))
    detail = F.array_join(F.transform("_r", lambda x: F.concat(x["reason"], F.lit("("), x["n"].cast("string"), F.lit(")"))), "；")
    return out.withColumns({"reason_detail": detail, "main_reason": F.col("_r")[0]["reason"]}).drop("_r")


def recent_overview(base: DataFrame, news: DataFrame, returning: DataFrame, abnormal: DataFrame) -> DataFrame:
    count = lambda df, name: df.agg(F.count("*").alias(name))
    flagged = returning.agg(F.count("*").alias("returning_users"), F.count_if("ever_hv").alias("returning_hv"))
    return metrics_long(count(news, "new_users").crossJoin(flagged).crossJoin(count(abnormal, "abnormal_users")).crossJoin(base.agg(F.count_distinct("user_id").alias("users"), F.count("*").alias("orders"))))


# ---- segments
def legacy_state_alias(state):
    return S.chain([(state == old, new) for old, new in V.LEGACY_STATES.items()], state)


def assign_segments(main: DataFrame, states: DataFrame, news: DataFrame, returning: DataFrame) -> DataFrame:
    """The main table with its high-value columns and segment_code: exactly one segment for each user, by priority. A user who is
    silent by the windows but in the main table counts as exited."""
    new = news.select("user_id").distinct().withColumn("_new", F.lit(True))
    out = main.join(states.select("user_id", legacy_state_alias(F.col("hv_state")).alias("hv_state"), "hv_segments", "hv_end"), "user_id", "left")
    out = out.join(new, "user_id", "left").join(returning.groupBy("user_id").agg(F.bool_or("ever_hv").alias("_hv")), "user_id", "left")
    out = out.withColumn("hv_state", F.when(F.col("hv_state") == V.SILENT, F.lit(V.EXITED)).otherwise(F.coalesce("hv_state", F.lit(""))))
    r, f, m, state = F.col("r_score"), F.col("f_score"), F.col("m_score"), F.col("hv_state")
    code = S.chain([
        (F.col("_new"), "01"), (~F.col("_hv"), "02"), (state == V.STABLE, "03"), (state == V.RETURNING, "04"), (state == V.EXITED, "05"),
        ((r <= 2) & (f >= 4), "06"), ((r >= 4) & (f <= 2) & (m >= 4), "07"), ((f <= 2) & (m <= 2), "08"), ((f >= 4) & (m <= 2), "09"),
    ], "11")
    return out.withColumn("segment_code", code).drop("_new", "_hv")


def final_segment(main: DataFrame, states: DataFrame, news: DataFrame, returning: DataFrame, abnormal: DataFrame, rules: V.SegmentRules = V.SegmentRules()) -> DataFrame:
    """Every user of the main table with the segment of assign_segments, and more conditions as columns beside it."""
    out = assign_segments(main, states, news, returning)
    out = out.join(abnormal.select("user_id").distinct().withColumn("_abn", F.lit(True)), "user_id", "left")
    m = F.col("m_score")
    names = F.create_map(*[F.lit(x) for pair in V.SEGMENTS for x in pair])
    last = main.agg(F.max("last_ts").alias("_last"))
    slot = lambda pref, c: F.when(F.col(pref) == V.TOO_FEW, F.lit(V.NONE)).otherwise(S.fill_none(F.col(c)))
    return out.crossJoin(F.broadcast(last)).select(
        "user_id", "segment_code", F.element_at(names, F.col("segment_code")).alias("segment"), "hv_state", "hv_segments", F.datediff("_last", "hv_end").alias("days_since_hv_exit"), "days_since_last",
        F.coalesce("_abn", F.lit(False)).alias("is_abnormal"), S.level_of(F.col("share_used_discount"), F.col("n_orders"), rules.min_orders, *rules.coupon).alias("coupon_level"), S.level_of(F.col("avg_valley_share"), F.col("n_orders"), rules.min_orders, *rules.valley).alias("valley_level"),
        "top_station", "top_hour1", ((F.col("n_orders") == 1) & (m >= 4)).alias("single_high"), "price_level", "station_pref", "time_pref", "risk_level",
        *[slot("station_pref", c).alias(f"pref_station{k}") for k, c in enumerate(("top_station", "station2", "station3"), 1)], *[slot("time_pref", c).alias(f"pref_hour{k}") for k, c in enumerate(("top_hour1", "top_hour2", "top_hour3"), 1)],
        "n_orders", "r_score", "f_score", "m_score", "rfm_type", "station_share1",
    )


def core7_segments(segments: DataFrame, rules: V.SegmentRules = V.SegmentRules()) -> DataFrame:
    return segments.where(F.col("segment_code").isin(*rules.core))


def silent_list(states: DataFrame, main: DataFrame) -> DataFrame:
    rows = states.where(F.col("hv_state") == V.SILENT).join(main.select("user_id"), "user_id", "left_anti")
    code, name = next(s for s in V.SEGMENTS if s[0] == "10")
    return rows.crossJoin(F.broadcast(main.agg(F.max("last_ts").alias("_last")))).select("user_id", F.lit(code).alias("segment_code"), F.lit(name).alias("segment"), "hv_state", "hv_segments", "hv_start", "hv_end", F.datediff("_last", "hv_end").alias("days_since_hv_exit"))


def silent_history_detail(orders: DataFrame, silent: DataFrame, bands: bool = False) -> DataFrame:
    """Orders, preference types and top three stations and periods over the whole history of the listed users only."""
    from .features import _concentration, ranked_values

    rows = exclude_category(orders).join(silent.select("user_id"), "user_id", "left_semi").withColumn("hour_label", S.rough_period(F.hour("start_ts")) if bands else S.hour_label(F.col("start_ts")))
    ranked = ranked_values(rows, {"station": "station_id", "hour": "hour_label"})
    out = rows.groupBy("user_id").agg(F.count("*").alias("n_orders")).join(_concentration(ranked, "station", ("station1", "station2", "station3")), "user_id", "left").join(_concentration(ranked, "hour", ("hour1", "hour2", "hour3")), "user_id", "left")
    c = F.col
    sp = S.station_preference(c("n_orders"), c("station_share1"), c("station_top2"), c("station_top3"), c("station_min2"), c("station_min3"), c("n_stations"))
    tp = S.time_preference(c("n_orders"), c("hour_share1"), c("hour_top2"), c("hour_share2"), c("hour_top3"), c("hour_share3"))
    slot = lambda pref, x: F.when(pref == V.TOO_FEW, F.lit(V.NONE)).otherwise(S.fill_none(c(x)))
    return out.select("user_id", "n_orders", sp.alias("station_pref"), tp.alias("time_pref"), *[slot(sp, f"station{k}").alias(f"station{k}") for k in (1, 2, 3)], *[slot(tp, f"hour{k}").alias(f"hour{k}") for k in (1, 2, 3)])


def segment_overview(segments: DataFrame, silent: DataFrame) -> DataFrame:
    spine = segments.sparkSession.range(1).select(F.explode(F.array(*[F.struct(F.lit(a).alias("segment_code"), F.lit(b).alias("segment")) for a, b in V.SEGMENTS])).alias("s")).select("s.*")
    counts = segments.groupBy("segment_code").agg(F.count("*").alias("users"))
    total = counts.agg(F.greatest(F.coalesce(F.sum("users"), F.lit(0)), F.lit(1)).alias("t"))
    out = spine.join(counts, "segment_code", "left").crossJoin(F.broadcast(total)).na.fill(0, ["users"])
    return out.select("segment_code", "segment", "users", S.round_n(F.col("users") / F.col("t"), 6).alias("share"))


def segment_checks(segments: DataFrame, assigned: DataFrame, core: DataFrame, states: DataFrame, silent: DataFrame, news: DataFrame, returning: DataFrame, abnormal: DataFrame, detail: DataFrame, rules: V.SegmentRules = V.SegmentRules()) -> DataFrame:
    """The segmentation's twenty assertions as rows (check_name, result, detail): two numbers that must be equal, but for
    small_segment, which warns, and top_preference_core, which is a bound. Sums and joins on the user; nothing is collected.

    assigned: the segments before any column was added beside them; core: the table of the core segments.
    """
    c, code = F.col, F.col("segment_code")
    main_codes = [a for a, _ in V.SEGMENTS if a != "10"]
    no_pref = lambda p: c(f"{p}_pref") == V.TOO_FEW
    slots = lambda prefix, p: [c(f"{prefix}{p}{k}") for k in (1, 2, 3)]
    any_slot = lambda prefix, test: F.exists(F.array(*slots(prefix, "station"), *slots(prefix, "hour")), test)
    unfilled = lambda prefix: (no_pref("station") & F.exists(F.array(*slots(prefix, "station")), lambda x: x != V.NONE)) | (no_pref("time") & F.exists(F.array(*slots(prefix, "hour")), lambda x: x != V.NONE))
    blank = lambda x: x.isNull() | (F.trim(x) == "")
    has_hv = c("hv_state") != ""
    total = lambda df, name: df.agg(F.count("*").alias(name))
    users = lambda df: df.select("user_id").distinct()
    outside = lambda df, name: total(users(df).join(segments.select("user_id"), "user_id", "left_anti"), name)
    per_code = segments.groupBy("segment_code").count().where(code.isin(*main_codes))
    filled = silent.select("user_id").join(detail, "user_id", "left").select("station_pref", "time_pref", *[S.fill_none(c(f"{p}{k}")).alias(f"{p}{k}") for p in ("station", "hour") for k in (1, 2, 3)])
    parts = [
        segments.agg(
            F.count("*").alias("n"), F.count_distinct("user_id").alias("ids"), F.count_if(~code.isin(*main_codes)).alias("odd"), F.count_if("is_abnormal").alias("abn"), F.count_if(c("hv_state") == V.SILENT).alias("sil"), F.count_if(has_hv).alias("hv"),
            F.count_if((code == "01") & has_hv).alias("new_hv"), F.count_if(code.isin("03", "04", "05")).alias("c345"), F.count_if(code.isin(*rules.core)).alias("core_codes"), F.count_if(no_pref("station") != no_pref("time")).alias("gate"),
            F.count_if(unfilled("pref_")).alias("too_few"), F.count_if(any_slot("pref_", blank)).alias("blank"),
        ),
        per_code.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("by_code"), F.count_if(c("count") < 100).alias("small")),
        total(segments.select("user_id", "segment_code").join(assigned.select("user_id", code.alias("_code")), "user_id", "left").where(~code.eqNullSafe(c("_code"))), "changed"),
        outside(news, "out_new"), outside(returning, "out_ret"), outside(abnormal, "out_abn"), total(users(abnormal), "abn_list"), total(states, "all_hv"), total(silent, "silent"),
        total(segments.where(code.isin("03", "04", "05")).join(users(returning), "user_id", "left_semi"), "absorbed"), total(users(returning.where("ever_hv")), "ret_hv"),
        core.agg(F.count("*").alias("core"), F.count_if(~code.isin(*rules.core)).alias("core_odd"), F.greatest(F.count_if(c("pref_station1") != V.NONE), F.count_if(c("pref_hour1") != V.NONE)).alias("core_pref")),
        total(silent.join(detail.select("user_id"), "user_id", "left_semi"), "detailed"), total(detail, "detail_n"), filled.agg(F.count_if(any_slot("", blank)).alias("sil_blank"), F.count_if(unfilled("")).alias("sil_too_few")),
    ]
    one = reduce(lambda a, b: a.crossJoin(F.broadcast(b)), parts)
    zero = F.lit(0)
    pairs = {
        "sum_of_segments": ("by_code", "n"), "unique_users": ("ids", "n"), "known_segments": ("odd", zero), "extra_columns_apart": ("changed", zero), "lists_inside_main": (c("out_new") + c("out_ret") + c("out_abn"), zero), "abnormal_flags": ("abn", "abn_list"),
        "four_states": (c("new_hv") + c("c345") + c("silent"), "all_hv"), "returning_absorbed": ("absorbed", "ret_hv"), "silent_outside_main": ("sil", zero), "high_value_inside_main": (c("hv") + c("silent"), "all_hv"), "core_count": ("core", "core_codes"), "core_only": ("core_odd", zero),
        "preference_gate": ("gate", zero), "too_few_slots_none": ("too_few", zero), "no_blank_preference": ("blank", zero), "silent_detail_complete": ("detailed", F.when(c("detail_n") > 0, c("silent")).otherwise(c("detailed"))), "silent_no_blank_preference": ("sil_blank", zero), "silent_too_few_slots_none": ("sil_too_few", zero),
    }
    col = lambda x: c(x) if isinstance(x, str) else x
    row = lambda name, result, a, b: F.struct(F.lit(name).alias("check_name"), result.alias("result"), F.concat_ws(" vs ", col(a).cast("string"), col(b).cast("string")).alias("detail"))
    verdict = lambda good, bad=V.FAIL: F.when(good, F.lit(V.PASS)).otherwise(F.lit(bad))
    rows = [row(k, verdict(col(a) == col(b)), a, b) for k, (a, b) in pairs.items()]
    rows += [row("small_segment", verdict(c("small") == 0, V.WARN), "small", zero), row("top_preference_core", verdict(c("core_pref") <= c("core")), "core_pref", "core")]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# ---- documented rules
RULE = "segment_code string, tier_from int, tier_to int, mark string, dependent boolean, priority int, coupon string, amount int, days int"


def coupon_rules(spark: SparkSession) -> DataFrame:
    """The rules as a table. Each has a second form for users who depend on coupons: full reductions and packages become a discount
    coupon, and the amount is one step lower. Of the rules that fit a user the one with the smallest priority holds."""
    rows = []
    for segment, low, high, mark, coupon, amount, days in V.COUPON_RULES:
        lower = V.AMOUNTS[max(0, V.AMOUNTS.index(amount) - 1)]
        plain = 1 if mark else 2
        rows.append((segment, low, high, mark, True, plain, V.DISCOUNT_COUPON if coupon in V.GIVES_WAY else coupon, lower, days))
        rows.append((segment, low, high, mark, False, plain, coupon, amount, days))
    return spark.createDataFrame(rows, RULE)


def coupon_assignment(segments: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """Coupon, largest amount and days by the rule table (RULE), which is small by nature; a user without a fitting rule gets none.
    Beside it whether the coupon is bound to the valley hours, whether a compensation goes with it, and its place in the sending."""
    spark = segments.sparkSession
    users = segments.select(
        "user_id", "segment_code", S.silence_tier(F.col("days_since_last")).alias("tier"), F.when(F.coalesce("hv_state", F.lit("")) != "", V.LOST).otherwise("").alias("_mark"),
        F.coalesce(F.col("coupon_level") == "高", F.lit(False)).alias("_dependent"), (F.col("valley_level") == "高").alias("valley_bound"), F.col("is_abnormal").alias("compensation"),
    ).withColumn("_tier", F.coalesce("tier", F.lit(0)))
    r = F.broadcast((coupon_rules(spark) if rules is None else rules).withColumnRenamed("segment_code", "_segment"))
    fits = (F.col("segment_code") == F.col("_segment")) & F.col("_tier").between(F.col("tier_from"), F.col("tier_to")) & F.col("mark").isin("", F.col("_mark")) & (F.col("dependent") == F.col("_dependent"))
    order = F.broadcast(spark.createDataFrame(V.TOUCH_ORDER, "_touch string, _from int, _to int, send_order int"))
    kept = ["user_id", "segment_code", "tier", "valley_bound", "compensation", "_tier"]
    best = users.join(r, fits, "left").groupBy(*kept).agg(F.min_by(F.struct("coupon", "amount", "days"), "priority").alias("best"))
    best = best.join(order, (F.col("segment_code") == F.col("_touch")) & F.col("_tier").between(F.col("_from"), F.col("_to")), "left")
    return best.select("user_id", "segment_code", "tier", "best.coupon", "best.amount", "best.days", "valley_bound", "compensation", "send_order")


def targeting_form(segments: DataFrame) -> DataFrame:
    hour = F.substring("top_hour1", 1, 2).try_cast("int")
    night, fixed = (hour >= 22) | (hour <= 7), F.col("station_share1") >= 0.5
    return segments.select("user_id", S.chain([(fixed & night, "绑站谷段券"), (fixed, "绑站通用券"), (night, "通用谷段券")], "通用券").alias("form"))


def legacy_hv_classes(states: DataFrame, last: DataFrame, new_days: int = 30) -> DataFrame:
    """Older class names: newly high-value, staged, returned then left. last: one row, end_date."""
    c = F.col
    name = S.chain([((c("hv_state") == V.STABLE) & (c("hv_start") >= F.date_sub("end_date", new_days - 1)), "新晋高价值"), (c("hv_state") == V.STABLE, "稳定高价值"), (c("hv_state") == V.RETURNING, "回流高价值"), ((c("hv_state") == V.EXITED) & (c("hv_segments") >= 2), "回流后退出"), (c("hv_state") == V.EXITED, "阶段性高价值")], "高价值流失")
    return states.crossJoin(F.broadcast(last)).select("user_id", "hv_state", name.alias("legacy_class"))
