"""Raw orders -> main, discarded and abnormal orders -> charging sessions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import values as V
from ..functions import scalars as S

TOU = ("peak", "flat", "valley")
RAW_KWH = ("peak_kwh", "sharp_kwh", "flat_kwh", "valley_kwh", "deep_valley_kwh", "low_valley_kwh")


def zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0.0))


def discard_rules(orders: DataFrame, rules: V.CleanRules = V.CleanRules()) -> DataFrame:
    """Adds discard_code (0: keep) and discard_reason: the first of 17 ordered rules that holds. Null numbers count as 0."""
    kwh, meter, ef, sf = zero("kwh"), zero("meter_kwh"), zero("ef"), zero("sf")
    start, end = F.col("start_ts"), F.col("end_ts")
    seconds = S.seconds_between(start, end)
    parts = reduce(lambda a, b: a + b, [zero(c) for c in RAW_KWH])
    conditions = (
        F.col("status").isin("废弃", "已取消"), kwh > 800, meter > 800, ef > 500, sf > 500, ef + sf > 800, kwh < 0, S.safe_divide(ef, kwh) > 4, meter < 0, seconds < 0,
        (kwh < 0.1) & (sf + ef != 0), (seconds > 0) & (kwh < 0.1), F.abs(kwh - meter) > 0.1, F.abs(parts - kwh) > 0.1, seconds > 64800, start.isNull() | end.isNull(),
        (start < F.lit(rules.earliest).cast("timestamp_ntz")) | (start > F.lit(rules.cutoff).cast("timestamp_ntz")),
    )
    code = S.chain([(c, k) for k, c in enumerate(conditions, 1)], 0)
    coded = orders.withColumn("discard_code", code)
    return coded.withColumn("discard_reason", F.coalesce(F.get(F.array(*[F.lit(r) for r in V.DISCARD_REASONS]), F.col("discard_code") - 1), F.lit("")))


def split_main_discard(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    return judged.where("discard_code = 0"), judged.where("discard_code <> 0")


def _hour_tables(segment: str) -> tuple[Column, Column]:
    """Of each tariff and hour 0 ... 24: the segment's seconds of the day before that hour, and whether the hour belongs to it."""
    inside = [[any(a <= h < b for a, b in tariff[segment]) for h in range(25)] for tariff in V.TARIFFS.values()]
    before = [3600 * sum(hours[:h]) for hours in inside for h in range(25)]
    return F.array(*[F.lit(x) for x in before]), F.array(*[F.lit(int(x)) for hours in inside for x in hours])


def with_tou_seconds(orders: DataFrame) -> DataFrame:
    """Adds seconds_peak, _flat, _valley: the start day and the day after, each by its own schedule. A segment's seconds up to a
    time of day come from small tables by hour, without explode."""
    start, end = F.col("start_ts"), F.col("end_ts")
    first = F.date_trunc("day", start).cast("timestamp")
    out = orders.withColumns({"_s": F.unix_seconds(start.cast("timestamp")), "_e": F.unix_seconds(end.cast("timestamp")), "_d0": F.unix_seconds(first), "_day0": F.to_date(first)})
    out = out.withColumns({"_d1": F.col("_d0") + 86400, "_day1": F.date_add("_day0", 1)})
    number = {name: k for k, name in enumerate(V.TARIFFS)}
    kind = lambda d: F.when(F.col(d) < F.lit(V.TARIFF_CHANGE).cast("date"), number["legacy"]).when(F.month(d).isin(*V.SEASON_MONTHS), number["summer_winter"]).otherwise(number["other"])
    inside = lambda t, d: F.least(F.greatest(F.col(t) - F.col(d), F.lit(0)), F.lit(86400)).cast("int")
    out = out.withColumns({f"_x{t}{n}": inside(t, f"_d{n}") for t in ("_s", "_e") for n in (0, 1)})
    out = out.withColumns({f"_i{t}{n}": kind(f"_day{n}") * 25 + F.expr(f"_x{t}{n} div 3600").cast("int") for t in ("_s", "_e") for n in (0, 1)})
    parts = {}
    for k in TOU:
        before, hour = _hour_tables(k)
        upto = lambda t, n: F.get(before, F.col(f"_i{t}{n}")) + F.col(f"_x{t}{n}") % 3600 * F.get(hour, F.col(f"_i{t}{n}"))  # noqa: E731, B023
        parts[f"seconds_{k}"] = reduce(lambda a, b: a + b, [F.greatest(upto("_e", n) - upto("_s", n), F.lit(0)) for n in (0, 1)])
    helpers = [f"{p}{t}{n}" for p in ("_x", "_i") for t in ("_s", "_e") for n in (0, 1)]
    return out.withColumns(parts).drop("_s", "_e", "_d0", "_d1", "_day0", "_day1", *helpers)


def tou_allocate(orders: DataFrame, kwh: str = "energy_kwh") -> DataFrame:
    """Splits an order's energy over the segments by seconds; nothing where times are missing, turned round or equal."""
    out = with_tou_seconds(orders).withColumn("_n", S.seconds_between(F.col("start_ts"), F.col("end_ts")))
    out = out.withColumns({f"{k}_kwh": F.when(F.col("_n") > 0, S.round_n(zero(kwh) * F.col(f"seconds_{k}") / F.col("_n"), 3)).otherwise(0.0) for k in TOU})
    return out.drop("_n", *[f"seconds_{k}" for k in TOU])


def derive_order_fields(main: DataFrame) -> DataFrame:
    """Fields of a main order: dates, period, duration, energy and its split, money, discount, price, power, end reason."""
    start, end = F.col("start_ts"), F.col("end_ts")
    out = main.withColumns({
        "charge_date": F.to_date(start), "charge_month": F.month(start), "weekday": S.weekday_name(start), "start_hour": F.hour(start), "period": S.rough_period(F.hour(start)),
        "is_cross_day": S.is_cross_day(start, end), "duration_min": S.round_n(S.seconds_between(start, end) / 60.0, 3), "energy_kwh": S.round_n(F.coalesce("kwh", "meter_kwh"), 3),
        "paid_electric": S.round_n(zero("paid_ef"), 2), "paid_service": S.round_n(zero("paid_sf"), 2),
    })
    out = tou_allocate(out).withColumn("paid_amount", S.round_n(F.col("paid_electric") + F.col("paid_service"), 2))
    discount = F.greatest(zero("coupon_discount") + zero("promotion_discount") + zero("other_discount"), F.greatest(zero("ef") + zero("sf") - F.col("paid_amount"), F.lit(0.0)))
    out = out.withColumns({"discount_amount": S.round_n(discount, 2), "used_discount": discount > 0, "end_reason_class": S.classify_end_reason(F.col("end_reason"))})
    return with_ratios(out)


def with_ratios(df: DataFrame) -> DataFrame:
    kwh, minutes = F.col("energy_kwh"), F.col("duration_min")
    some = F.when(kwh > 0, kwh)
    return df.withColumns({
        "duration_bucket": S.duration_bucket_13(minutes), "energy_bucket": S.energy_bucket(kwh), "valley_share": S.round_n(S.safe_divide(F.col("valley_kwh"), some), 3),
        "unit_price": S.round_n(S.safe_divide(F.col("paid_amount"), some), 3), "avg_power_kw": S.round_n(S.safe_divide(some, F.when(minutes > 0, minutes) / 60), 3),
    })


def abnormal_orders(main: DataFrame) -> DataFrame:
    return main.where(F.col("end_reason_class").isin(V.END_FAULT, V.END_OTHER))


def _owner(rules: V.CleanRules) -> Column:
    """One key for the owner of a row, its user (and source): null users and sources stay apart from empty ones."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit(""))
    return F.concat(part("source_table"), F.lit("\n"), part("user_id")) if rules.partition_by_source else part("user_id")


def heavy_users(df: DataFrame, rules: V.CleanRules = V.CleanRules(), least: int = 1_000_000, share: float = 1e-5) -> DataFrame:
    """Owners of more than ``least`` rows and more than ``share`` of all rows, for order_sequence and restart_sessions. There are at
    most 1 / share of them however large the table, which is what lets them be broadcast. Counting reads only the owner's column."""
    counts = df.groupBy(_owner(rules).alias("_who")).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"))
    return counts.crossJoin(F.broadcast(total)).where((F.col("_n") > least) & (F.col("_n") > F.col("_all") * share)).select("_who")


def _parts(df: DataFrame, rules: V.CleanRules, heavy: DataFrame | None, order: tuple[str, ...], last: tuple[str, ...], month: Column) -> DataFrame:
    """df with _who and _part, the keys of its windows, and what the earlier parts of an owner hand on: _before and _month_before
    (numbers of rows) and _last (columns of the last row).

    A user's rows are one part. The rows without a user, and those of the heavy users, are a part per day: one owner may hold a large
    part of the table, and a task then has a day of it instead. What is handed on is made from one row per owner and day. Without
    heavy users these are as many rows as days and are broadcast; with them the join is left to Spark, on the keys of the windows.
    """
    out = df.withColumns({"_who": _owner(rules), "_month": month})
    large = F.col("user_id").isNull()
    if heavy is not None:
        out = out.join(F.broadcast(heavy.withColumn("_heavy", F.lit(True))), "_who", "left")
        large = large | F.coalesce("_heavy", F.lit(False))
    out = out.withColumn("_part", F.when(large, F.coalesce(F.to_date("start_ts").cast("string"), F.lit("none"))).otherwise("")).drop("_heavy")
    at = F.struct(*order)
    days = out.where("_part <> ''").groupBy("_who", "_part", "_month").agg(F.count("*").alias("n"), F.min("start_ts").alias("_from"), F.max_by(F.struct(*last), at).alias("l"))
    w, m = Window.partitionBy("_who").orderBy("_from"), Window.partitionBy("_who", "_month").orderBy("_from")
    before = lambda x: F.coalesce(F.sum("n").over(x.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    days = days.select("_who", "_part", before(w).alias("_before"), before(m).alias("_month_before"), F.lag("l").over(w).alias("_last"))
    return out.join(F.broadcast(days) if heavy is None else days, ["_who", "_part"], "left").na.fill(0, ["_before", "_month_before"])


HELPERS = ("_who", "_part", "_month", "_before", "_month_before", "_last", "_b")


def order_sequence(df: DataFrame, rules: V.CleanRules = V.CleanRules(), by_year_month: bool = False, heavy: DataFrame | None = None) -> DataFrame:
    """Adds user_seq, user_month_seq (by month number over all years, or by year and month), gap_h and its bucket, is_first,
    reuse_station. ``heavy``: users whose rows are split by day, as found by heavy_users; the result is the same without."""
    order, last = ("start_ts", "order_id"), ("start_ts", "station_id")
    out = _parts(df, rules, heavy, order, last, F.date_trunc("month", "start_ts") if by_year_month else F.month("start_ts"))
    w, m = Window.partitionBy("_who", "_part").orderBy(*order), Window.partitionBy("_who", "_part", "_month").orderBy(*order)
    before = F.when(F.row_number().over(w) > 1, F.lag(F.struct(*last)).over(w)).otherwise(F.col("_last"))
    out = out.withColumns({"user_seq": (F.row_number().over(w) + F.col("_before")).cast("int"), "_b": before, "user_month_seq": (F.row_number().over(m) + F.col("_month_before")).cast("int")})
    gone, station = F.col("_b.start_ts"), F.col("_b.station_id")
    both = F.col("station_id").isNotNull() & station.isNotNull()
    reuse = S.chain([(F.col("user_seq") == 1, "首次充电"), (~both, "站点缺失"), (F.col("station_id") == station, V.YES)], V.NO)
    out = out.withColumns({"gap_h": S.round_n(S.seconds_between(gone, F.col("start_ts")) / 3600.0, 3), "is_first": F.col("user_seq") == 1, "reuse_station": reuse})
    return out.withColumn("gap_bucket", S.interval_bucket(F.col("gap_h"))).drop(*HELPERS)


def restart_sessions(df: DataFrame, rules: V.CleanRules = V.CleanRules(), heavy: DataFrame | None = None) -> DataFrame:
    """Adds session_no: a new session starts unless the row before is of the same user and station and ended 0 to restart_seconds ago.
    ``heavy`` as in order_sequence: a session may run over several parts, so the parts' numbers of sessions are handed on too."""
    order, last = ("start_ts", "end_ts", "order_id"), ("end_ts", "station_id")
    out = _parts(df, rules, heavy, order, last, F.month("start_ts"))
    w = Window.partitionBy("_who", "_part").orderBy(*order)
    out = out.withColumn("_b", F.when(F.row_number().over(w) > 1, F.lag(F.struct(*last)).over(w)).otherwise(F.col("_last")))
    gap = S.seconds_between(F.col("_b.end_ts"), F.col("start_ts"))
    follows = F.col("user_id").isNotNull() & (F.col("station_id") == F.col("_b.station_id")) & gap.between(0, rules.restart_seconds)
    out = out.withColumn("_new", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1))
    out = out.withColumn("session_no", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    if heavy is not None:
        made = out.where("_part <> ''").groupBy("_who", "_part").agg(F.sum("_new").alias("n"), F.min("start_ts").alias("_from"))
        upto = F.sum("n").over(Window.partitionBy("_who").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1))
        out = out.drop("_before").join(made.select("_who", "_part", F.coalesce(upto, F.lit(0)).alias("_before")), ["_who", "_part"], "left").na.fill(0, ["_before"])
    return out.withColumn("session_no", F.col("session_no") + F.col("_before")).drop("_new", *HELPERS)


FIRST = ("order_id", "status", "charge_method", "channel", "station_id", "charger_id")
SUMS = ("energy_kwh", "peak_kwh", "flat_kwh", "valley_kwh", "paid_electric", "paid_service", "paid_amount", "discount_amount")


def merge_restart_orders(numbered: DataFrame) -> DataFrame:
    """One row per session: first value that is not null of text columns in time order, sums, first start, last end, any discount,
    distinct reasons, number of orders; duration, shares, price and power anew."""
    at = F.struct("start_ts", "end_ts", "order_id")
    first = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c) for c in FIRST if c in numbered.columns]
    reasons = [S.join_reasons(F.transform(F.sort_array(F.collect_list(F.struct(at.alias("at"), F.col(c).alias("r")))), lambda x: x["r"])).alias(c) for c in ("end_reason_class", "end_reason")]
    out = numbered.groupBy("user_id", "session_no").agg(
        *first,
        *[S.round_n(F.sum(F.col(c).cast("decimal(18,3)")).cast("double"), 3).alias(c) for c in SUMS],
        F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"), F.bool_or("used_discount").alias("used_discount"), F.count("*").alias("raw_orders"), *reasons,
    )
    start, end = F.col("start_ts"), F.col("end_ts")
    out = out.withColumns({
        "charge_date": F.to_date(start), "charge_month": F.month(start), "weekday": S.weekday_name(start), "start_hour": F.hour(start), "period": S.rough_period(F.hour(start)),
        "is_cross_day": S.is_cross_day(start, end), "duration_min": S.round_n(S.seconds_between(start, end) / 60.0, 3), "is_merged": F.col("raw_orders") > 1, "abnormal_reason": F.lit(""), "is_valid": F.lit(True),
    })
    return with_ratios(out)


def clean_sessions(judged: DataFrame, rules: V.CleanRules = V.CleanRules(), heavy: DataFrame | None = None) -> DataFrame:
    """Whole chain: main orders, fields, restart merge, then the sequence columns on sessions. ``heavy``: heavy_users(judged), where
    single users may hold a large part of the orders; the result is the same without."""
    main = derive_order_fields(split_main_discard(judged)[0])
    return order_sequence(merge_restart_orders(restart_sessions(main, rules, heavy)), rules, heavy=heavy)


def restart_summary(sessions: DataFrame) -> DataFrame:
    return sessions.agg(F.sum("raw_orders").alias("before_merge"), F.count("*").alias("after_merge"), (F.sum("raw_orders") - F.count("*")).alias("reduced"), F.count_if(F.col("raw_orders") > 1).alias("merged_groups"))


def metrics_long(one_row: DataFrame) -> DataFrame:
    """One row of numbers -> (metric, value)."""
    return one_row.select(*[F.col(c).cast("long") for c in one_row.columns]).unpivot([], one_row.columns, "metric", "value")


def cleaning_overview(judged: DataFrame, sessions: DataFrame) -> DataFrame:
    main = F.col("discard_code") == 0
    kind = S.classify_end_reason(F.col("end_reason"))
    raw = judged.agg(
        F.count("*").alias("raw_orders"), F.count_if(main).alias("kept_orders"), F.count_if(~main).alias("discarded_orders"),
        F.count_if(main & kind.isin(V.END_FAULT, V.END_OTHER)).alias("abnormal_orders"), F.count_if(~main & (zero("kwh") <= 0)).alias("discarded_zero_energy"),
    )
    done = sessions.agg(F.count("*").alias("sessions"), F.count_if(F.col("energy_kwh") <= 0).alias("main_zero_energy"), F.count_if("is_valid").alias("valid_sessions"), F.count_distinct("user_id").alias("users"), F.count_distinct("station_id").alias("stations"), F.count_if("is_merged").alias("merged_groups"))
    return metrics_long(raw.crossJoin(done))


def field_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: missing values, their share (4 places), distinct values; two plain aggregations whatever the number of columns.
    An empty table has a row for each column too."""
    values = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "field", "value")
    counts = values.groupBy("field", "value").agg(F.count("*").alias("n"))
    got = counts.groupBy("field").agg(F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing"), F.sum("n").alias("n"), F.count("value").alias("distinct_values"))
    fields = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("field"))
    out = fields.join(got, "field", "left").na.fill(0, ["missing", "n", "distinct_values"])
    return out.select("field", "missing", S.round_n(F.coalesce(F.try_divide("missing", "n"), F.lit(0.0)), 4).alias("missing_rate"), "distinct_values")


# ---- stations
def load_station_dims(station: DataFrame, order: tuple[str, ...] = ("station_name", "station_id")) -> DataFrame:
    """Station rows with a normalized key and category, one per key: the first by ``order`` where a key repeats. For the order of
    the file, read it with a column of row numbers (_metadata.row_index of Parquet) and name that."""
    key = S.normalize_station_key(F.col("station_id"))
    rows = station.withColumn("station_key", key).where("station_key IS NOT NULL").withColumn("category", S.station_type_to_category(F.col("station_type")))
    w = Window.partitionBy("station_key").orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("station_key", "station_name", "place", "category")


def name_category_pick(station: DataFrame) -> DataFrame:
    rows = station.select(S.normalize_text(F.col("station_name")).alias("station_name"), S.station_type_to_category(F.col("station_type")).alias("category")).where("station_name IS NOT NULL")
    rank = F.array_position(F.array(*[F.lit(c) for c in V.CATEGORY_PRIORITY]), F.col("category"))
    return rows.groupBy("station_name").agg(F.min_by("category", rank).alias("category"))


def resolve_station_id(df: DataFrame, dims: DataFrame, bridge: DataFrame) -> DataFrame:
    """station_id as it is if known, else its code by the bridge, else as it is. Small dimensions are broadcast by their size."""
    codes = bridge.select(S.normalize_station_key(F.col("station_uuid")).alias("station_id"), S.normalize_station_key(F.col("station_code")).alias("_code")).dropDuplicates(["station_id"])
    known = dims.select(F.col("station_key").alias("station_id"), F.lit(True).alias("_known"))
    out = df.join(known, "station_id", "left").join(codes, "station_id", "left")
    return out.withColumn("resolved_id", F.when(F.col("_known"), F.col("station_id")).otherwise(F.coalesce("_code", "station_id"))).drop("_known", "_code")


def attach_station(df: DataFrame, dims: DataFrame, names: DataFrame) -> DataFrame:
    """Category and place by resolved id; where the category is 其他, the one picked for the station's name."""
    by_id = dims.select(F.col("station_key").alias("resolved_id"), F.col("category").alias("_c"), "place", F.col("station_name").alias("_n"))
    by_name = names.select(F.col("station_name").alias("_n"), F.col("category").alias("_c2"))
    out = df.join(by_id, "resolved_id", "left").withColumn("_n", F.coalesce("_n", *(["station_name"] if "station_name" in df.columns else []))).join(by_name, "_n", "left")
    first = F.coalesce("_c", F.lit(V.OTHER))
    return out.withColumn("station_category", F.when(first != V.OTHER, first).otherwise(F.coalesce("_c2", F.lit(V.OTHER)))).drop("_c", "_c2", "_n")


def station_detail(df: DataFrame) -> DataFrame:
    """Per station: orders, first seen, dominant category (most orders, then the fixed order). Blank stations are left out."""
    rank = F.array_position(F.array(*[F.lit(c) for c in V.CATEGORIES]), F.col("station_category"))
    rows = df.where(F.trim(F.coalesce("station_id", F.lit(""))) != "").withColumn("station_category", F.when(rank > 0, F.col("station_category")).otherwise(V.OTHER))
    counts = rows.groupBy("station_id", "station_category").agg(F.count("*").alias("n"), F.min("start_ts").alias("t"))
    return counts.groupBy("station_id").agg(F.max_by("station_category", F.struct("n", -rank)).alias("category"), F.min("t").alias("first_seen"), F.sum("n").alias("orders"))


def category_share(df: DataFrame, weight: Column | None = None) -> DataFrame:
    """Per fixed category: orders (weighted), stations, share; blank stations count as 其他 but as no station."""
    known = F.when(F.col("station_category").isin(*V.CATEGORIES), F.col("station_category")).otherwise(V.OTHER)
    blank = F.trim(F.coalesce("station_id", F.lit(""))) == ""
    rows = df.select(F.when(blank, F.lit(V.OTHER)).otherwise(known).alias("category"), F.when(~blank, F.col("station_id")).alias("s"), (weight if weight is not None else F.lit(1)).alias("w"))
    got = rows.groupBy("category").agg(F.sum("w").alias("orders"), F.count_distinct("s").alias("stations"))
    spine = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in V.CATEGORIES])).alias("category"))
    out = spine.join(got, "category", "left").na.fill(0, ["orders", "stations"])
    return out.withColumn("share", S.round_n(F.coalesce(F.try_divide("orders", F.sum("orders").over(Window.partitionBy())), F.lit(0.0)), 4))


def high_frequency_threshold(df: DataFrame, yearly: int = 365) -> DataFrame:
    days = F.greatest(F.lit(1), F.datediff(F.max("start_ts"), F.min("start_ts")) + 1)
    return df.agg(F.coalesce(F.least(F.lit(yearly), F.greatest(F.lit(1), F.ceil(yearly * days / 365.0))), F.lit(yearly)).cast("int").alias("threshold"), F.coalesce(F.when(F.max("start_ts").isNotNull(), days), F.lit(0)).alias("covered_days"))


def high_frequency_exclusion(df: DataFrame, yearly: int = 365) -> DataFrame:
    """Orders of users whose order count does not exceed the threshold of the covered days."""
    heavy = df.groupBy("user_id").count().crossJoin(F.broadcast(high_frequency_threshold(df, yearly))).where("count > threshold").select("user_id")
    return df.join(heavy, "user_id", "left_anti")
