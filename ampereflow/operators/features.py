"""Cleaned orders -> order behaviour base -> user features, scores, labels and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import values as V
from ..functions import scalars as S
from .cleaning import metrics_long, order_sequence

FLAGS = ("is_small_hours", "is_weekend", "is_night", "is_cross_day", "is_short", "is_long", "is_high_energy", "used_discount", "valley_order", "reused_station", "is_risk", "is_fault_end", "is_zero", "is_overlong")
TOPS = {"method": "charge_method", "channel": "channel", "charger": "charger_id", "reason": "abnormal_reason"}


def exclude_category(df: DataFrame, category: str = V.BUS) -> DataFrame:
    return df.where(F.trim(F.coalesce("station_category", F.lit(""))) != category)


def recent_window(df: DataFrame, days: int = 90) -> DataFrame:
    """Orders from the last ``days`` days before the last start, to the second; the maximum is one broadcast row."""
    last = df.agg(F.max("start_ts").alias("_max"))
    return df.crossJoin(F.broadcast(last)).where(F.col("start_ts") >= F.col("_max") - F.make_dt_interval(F.lit(days))).drop("_max")


def valid_user_filter(df: DataFrame) -> DataFrame:
    return df.where((F.trim(F.coalesce("user_id", F.lit(""))) != "") & F.col("is_valid"))


def sequenced(orders: DataFrame) -> DataFrame:
    """Orders with gap_h and reuse_station: as they are if cleaning has made these, else taken from all rows of orders."""
    return orders if {"gap_h", "reuse_station"} <= set(orders.columns) else order_sequence(orders)


def order_behavior_base(orders: DataFrame, first: str = "2020-01-01", until: str = "2027-01-01") -> DataFrame:
    """Order columns with flags; expects sequenced orders with is_valid as text or boolean: a gap or a reused station reaches back
    over whatever is filtered out here or before. Bus stations and starts outside [first, until) are left out. Where orders have no
    source_table, data_year is the natural year; other columns that they lack (user_code, order_source, energy by tariff) are null."""
    given = lambda c, kind, made=None: F.col(c) if c in orders.columns else F.lit(made).cast(kind)
    rows = exclude_category(orders).where((F.col("start_ts") >= F.lit(first).cast("timestamp")) & (F.col("start_ts") < F.lit(until).cast("timestamp")))
    start, end, hour = F.col("start_ts"), F.col("end_ts"), F.hour("start_ts")
    rows = rows.withColumns({
        "is_valid": S.is_yes(F.col("is_valid")), "abnormal_reason": S.clean_text(F.col("abnormal_reason")), "end_reason_class": S.clean_text(F.col("end_reason_class"), V.UNKNOWN),
        "duration_min": S.round_n(S.seconds_between(start, end) / 60.0, 3), "discount_amount": F.coalesce("discount_amount", F.lit(0.0)),
        "used_discount": S.is_yes(given("used_discount", "boolean", False)),
    })
    minutes, kwh, paid, off = F.col("duration_min"), F.col("energy_kwh"), F.col("paid_amount"), F.col("discount_amount")
    fault = F.col("end_reason_class").isin(V.END_FAULT)
    return rows.select(
        "order_id", "user_id", "start_ts", "end_ts", "station_id", "charger_id", "station_category", "charge_method", "channel", "end_reason_class", "abnormal_reason", "is_valid",
        F.year(start).alias("natural_year"), F.to_date(start).alias("charge_date"), F.month(start).alias("charge_month"), hour.alias("start_hour"), S.weekday_name(start).alias("weekday"), S.hour_label(start).alias("hour_label"),
        "duration_min", "energy_kwh", "paid_amount", "discount_amount", S.round_n("valley_share", 4).alias("valley_share"), "gap_h",
        S.round_n(S.safe_divide(off, F.coalesce(paid, F.lit(0.0)) + off), 4).alias("discount_share"), S.round_n(S.safe_divide(paid, F.when(kwh > 0, kwh)), 4).alias("unit_price"), S.round_n(S.safe_divide(kwh * 60, F.when(minutes > 0, minutes)), 3).alias("power_kw"),
        S.is_weekend(start).alias("is_weekend"), ((hour >= 18) | (hour <= 5)).alias("is_night"), (hour <= 5).alias("is_small_hours"), S.is_cross_day(start, end).alias("is_cross_day"),
        F.coalesce(minutes <= 30, F.lit(False)).alias("is_short"), F.coalesce(minutes > 240, F.lit(False)).alias("is_long"), F.coalesce(kwh >= 40, F.lit(False)).alias("is_high_energy"), F.coalesce(kwh <= 0, F.lit(False)).alias("is_zero"),
        F.coalesce(F.col("valley_share") >= 0.5, F.lit(False)).alias("valley_order"), (F.col("used_discount") | (off > 0)).alias("used_discount"), (F.col("reuse_station") == V.YES).alias("reused_station"), (~F.col("is_valid")).alias("is_invalid"),
        (F.col("is_valid") & (~F.col("abnormal_reason").isin("", V.NONE, "None", "null") | fault)).alias("is_risk"), fault.alias("is_fault_end"), F.coalesce(minutes > 240, F.lit(False)).alias("is_overlong"),
        F.coalesce(S.source_table_year(given("source_table", "string")), F.year(start)).alias("data_year"), F.trim(given("user_code", "string")).alias("user_code"), S.clean_text(given("order_source", "string"), V.UNKNOWN).alias("order_source"),
        *[S.round_n(given(f"{k}_kwh", "double"), 3).alias(f"{k}_kwh") for k in ("peak", "flat", "valley")],
    )


def _dec(c: str) -> Column:
    return F.col(c).cast("decimal(18,3)")


def _mean(c: str) -> Column:
    """Mean through decimals: thresholds that it meets exactly do not hang on the order of rows."""
    return F.try_divide(F.sum(F.col(c).cast("decimal(18,4)")).cast("double"), F.count(c))


def _kinds(c: Column) -> Column:
    """Number of distinct values in a group that holds few (days of one user): sets, where distinct counts would multiply the rows."""
    return F.size(F.collect_set(c)).cast("long")


def user_features(base: DataFrame) -> DataFrame:
    """Aggregates per user: counts, distinct periods, flag sums, sums, means and exact medians."""
    return base.groupBy("user_id").agg(
        F.count("*").alias("n_orders"), _kinds(F.col("natural_year")).alias("n_years"), _kinds(S.year_month(F.col("start_ts"))).alias("n_months"), _kinds(F.col("charge_date")).alias("n_days"),
        F.min("start_ts").alias("first_ts"), F.max("start_ts").alias("last_ts"), *[F.count_if(f).alias(f"n_{f}") for f in FLAGS],
        F.sum(_dec("energy_kwh")).cast("double").alias("sum_kwh"), _mean("energy_kwh").alias("avg_kwh"), F.median("energy_kwh").alias("median_kwh"),
        F.avg("duration_min").alias("avg_minutes"), F.median("duration_min").alias("median_minutes"), F.avg("power_kw").alias("avg_power"), _mean("valley_share").alias("avg_valley_share"),
        F.sum(_dec("paid_amount")).cast("double").alias("sum_paid"), F.avg("paid_amount").alias("avg_paid"), F.avg("unit_price").alias("avg_unit_price"), F.sum(_dec("discount_amount")).cast("double").alias("sum_discount"), F.avg("discount_share").alias("avg_discount_share"),
        F.avg("gap_h").alias("avg_gap_h"), F.median("gap_h").alias("median_gap_h"), F.count("gap_h").alias("n_gaps"),
    )


def user_ratio_features(features: DataFrame, sample_max: DataFrame) -> DataFrame:
    """Flag shares, days since the last order of all, span (14 at least) and days per order. sample_max: one row, sample_max."""
    out = features.crossJoin(F.broadcast(sample_max))
    shares = {f"share_{f}": F.try_divide(F.col(f"n_{f}"), F.col("n_orders")) for f in FLAGS}
    span = F.greatest(F.datediff("sample_max", "first_ts") + 1, F.lit(14))
    return out.withColumns(shares | {"days_since_last": F.datediff("sample_max", "last_ts"), "span_days": span, "days_per_order": F.try_divide(span.cast("double"), F.col("n_orders"))}).drop("sample_max")


def ranked_values(base: DataFrame, columns: dict[str, str]) -> DataFrame:
    """(user_id, attribute, value, n, total, kinds, rn): values of several attributes counted in one pass; blank ones left out."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("attribute"), F.trim(F.col(c)).alias("value")) for k, c in columns.items()])).alias("p")
    counts = base.select("user_id", pairs).select("user_id", "p.*").where(F.col("value").isNotNull() & ~F.col("value").isin("", V.UNKNOWN)).groupBy("user_id", "attribute", "value").agg(F.count("*").alias("n"))
    w = Window.partitionBy("user_id", "attribute")
    return counts.select("*", F.sum("n").over(w).alias("total"), F.count("*").over(w).alias("kinds"), F.row_number().over(w.orderBy(F.desc("n"), "value")).alias("rn"))


def top_value(base: DataFrame, columns: dict[str, str] = TOPS) -> DataFrame:
    """Per user and attribute the commonest value (the smaller on a tie), its share and the number of values."""
    return ranked_values(base, columns).where("rn = 1").select("user_id", "attribute", "value", F.expr("n / total").alias("share"), "kinds")


def _concentration(ranked: DataFrame, attribute: str, names: tuple[str, str, str]) -> DataFrame:
    nth = lambda k, c: F.max(F.when(F.col("rn") == k, F.col(c)))
    share = lambda k: F.coalesce(nth(k, "n"), F.lit(0)) / F.max("total")
    one, two, three = share(1), share(2), share(3)
    a = attribute
    return ranked.where(F.col("attribute") == a).groupBy("user_id").agg(
        *[nth(k, "value").alias(n) for k, n in enumerate(names, 1)], one.alias(f"{a}_share1"), two.alias(f"{a}_share2"), three.alias(f"{a}_share3"), (one + two).alias(f"{a}_top2"), (one + two + three).alias(f"{a}_top3"),
        F.least(one, two).alias(f"{a}_min2"), F.least(one, two, three).alias(f"{a}_min3"), F.max("kinds").alias(f"n_{a}s"),
    )


def station_concentration(base: DataFrame) -> DataFrame:
    return _concentration(ranked_values(base, {"station": "station_id"}), "station", ("top_station", "station2", "station3"))


def time_concentration(base: DataFrame) -> DataFrame:
    return _concentration(ranked_values(base, {"hour": "hour_label"}), "hour", ("top_hour1", "top_hour2", "top_hour3"))


def station_top3_detail(base: DataFrame) -> DataFrame:
    ranked = ranked_values(base, {"station": "station_id"}).where("rn <= 3")
    nth = lambda k, e: F.max(F.when(F.col("rn") == k, e))
    return ranked.groupBy("user_id").agg(*[x for k in (1, 2, 3) for x in (nth(k, F.col("value")).alias(f"station{k}"), nth(k, F.col("n")).alias(f"n{k}"), S.round_n(nth(k, F.col("n") / F.col("total")), 6).alias(f"share{k}"))])


def user_wide(orders: DataFrame, days: int = 90, first: str = "2020-01-01") -> DataFrame:
    """Wide user table over the recent window: aggregates, shares, concentrations and top values. Gaps and reused stations come
    from the full history of orders."""
    recent = recent_window(exclude_category(sequenced(orders)), days)
    base = order_behavior_base(recent, first)
    valid = valid_user_filter(base)
    sample_max = base.agg(F.max("start_ts").alias("sample_max"))
    out = user_ratio_features(user_features(valid), sample_max)
    ranked = ranked_values(valid, {"station": "station_id", "hour": "hour_label"} | TOPS)
    out = out.join(_concentration(ranked, "station", ("top_station", "station2", "station3")), "user_id", "left").join(_concentration(ranked, "hour", ("top_hour1", "top_hour2", "top_hour3")), "user_id", "left")
    tops = ranked.where("rn = 1").groupBy("user_id").agg(*[F.max(F.when(F.col("attribute") == a, F.col("value"))).alias(f"top_{a}") for a in TOPS])
    zeros = [f"{a}_{k}" for a in ("station", "hour") for k in ("share1", "share2", "share3", "top2", "top3", "min2", "min3")]
    return out.join(tops, "user_id", "left").na.fill(0, [*zeros, "n_stations", "n_hours"])


def rfm_scores(df: DataFrame, days: str = "days_since_last", frequency: str = "days_per_order", kwh: str = "avg_kwh", window_days: int = 90) -> DataFrame:
    out = df.withColumns({"r_score": S.r_score(F.col(days), window_days), "f_score": S.f_score(F.col(frequency)), "m_score": S.m_score(F.col(kwh))})
    out = out.withColumns({"r_level": S.level(F.col("r_score"), V.R_LEVELS), "f_level": S.level(F.col("f_score"), V.F_LEVELS), "m_level": S.level(F.col("m_score"), V.M_LEVELS)})
    return out.withColumn("rfm_type", S.rfm_type(F.col("r_score"), F.col("f_score"), F.col("m_score")))


def rfm_segments(wide: DataFrame, window_days: int = 90) -> DataFrame:
    c = F.col
    out = rfm_scores(wide, window_days=window_days).withColumn("rfm_total", c("r_score") + c("f_score") + c("m_score"))
    out = out.withColumns({
        "rfm_mean": S.round_n(c("rfm_total") / 3, 3), "price_level": S.price_sensitivity(c("share_used_discount"), c("avg_valley_share")),
        "station_pref": S.station_preference(c("n_orders"), c("station_share1"), c("station_top2"), c("station_top3"), c("station_min2"), c("station_min3"), c("n_stations")),
        "time_pref": S.time_preference(c("n_orders"), c("hour_share1"), c("hour_top2"), c("hour_share2"), c("hour_top3"), c("hour_share3")),
        "risk_level": S.risk_level(c("share_is_risk"), c("share_is_fault_end"), c("share_is_overlong")),
    })
    return out.withColumn("user_labels", S.user_labels(c("rfm_type"), c("f_level"), c("r_level"), c("price_level"), c("station_pref"), c("risk_level")))


def final_profile(segments: DataFrame) -> DataFrame:
    parts = (("活跃度", "r_level"), ("频次", "f_level"), ("价值", "m_level"), ("价格", "price_level"), ("站点", "station_pref"), ("时段", "time_pref"), ("风险", "risk_level"))
    return segments.withColumn("behavior_pattern", F.concat_ws("；", *[F.concat(F.lit(f"{k}:"), F.coalesce(F.col(c), F.lit(""))) for k, c in parts]))


def ranked_output(df: DataFrame, order: tuple[str, ...] = ("-n_orders", "-sum_paid", "-sum_kwh")) -> DataFrame:
    """Rows in the order in which they are written or shown; a minus means falling, ties go by user. RFM tables use
    ("rfm_total", "-sum_kwh", "-n_orders")."""
    return df.orderBy(*[F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order], "user_id")


LABELS = ("r_level", "f_level", "m_level", "rfm_type", "price_level", "station_pref", "risk_level")
FINAL = ("user_id", "n_orders", "n_months", "last_ts", "days_since_last", "top_hour1", "hour_share1", "top_hour2", "hour_share2", "top_hour3", "hour_share3", "hour_top2", "hour_top3", "time_pref", "sum_kwh", "sum_paid", "share_used_discount", "n_stations", *LABELS[:3], "rfm_total", "rfm_type", "price_level", "station_pref", "risk_level", "user_labels", "behavior_pattern")


def final_labels(profile: DataFrame) -> DataFrame:
    return profile.select(*[c for c in dict.fromkeys(FINAL)])


def label_distribution(segments: DataFrame, labels: tuple[str, ...] = LABELS) -> DataFrame:
    rows = segments.select(*labels).unpivot([], list(labels), "dimension", "label").groupBy("dimension", "label").agg(F.count("*").alias("users"))
    return rows.withColumn("share", S.round_n(F.col("users") / F.sum("users").over(Window.partitionBy("dimension")), 4))


def multi_label_count(segments: DataFrame) -> DataFrame:
    return segments.select(F.explode(F.split("user_labels", "；")).alias("label")).groupBy("label").agg(F.count("*").alias("users"))


def nested_counts(segments: DataFrame) -> DataFrame:
    """Label counts within the RFM types; 样本不足 is left out of the two preferences."""
    labels = ["price_level", "risk_level", "station_pref", "time_pref"]
    rows = segments.select("rfm_type", *labels).unpivot(["rfm_type"], labels, "dimension", "label")
    rows = rows.where(~(F.col("dimension").isin("station_pref", "time_pref") & (F.col("label") == V.TOO_FEW)))
    return rows.groupBy("rfm_type", "dimension", "label").agg(F.count("*").alias("users"))


def field_scope_overview(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.year("start_ts").alias("natural_year")).agg(
        F.count("*").alias("orders"), F.count_distinct("user_id").alias("users"), F.count_if(S.is_yes(F.col("is_valid"))).alias("valid_orders"), F.count_if(S.clean_text(F.col("abnormal_reason")) != "").alias("abnormal_orders"),
        F.min(F.to_date("start_ts")).alias("first_date"), F.max(F.to_date("start_ts")).alias("last_date"), F.count_if(F.col("user_id").isNull() | F.col("station_id").isNull()).alias("missing_required"),
    )


def category_distribution(df: DataFrame, columns: list[str], top: int = 12) -> DataFrame:
    """Per column the commonest values with count and share."""
    rows = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "field", "value").groupBy("field", "value").agg(F.count("*").alias("n"))
    w = Window.partitionBy("field")
    rows = rows.select("*", S.round_n(F.col("n") / F.sum("n").over(w), 4).alias("share"), F.row_number().over(w.orderBy(F.desc("n"), "value")).alias("rank"))
    return rows.where(F.col("rank") <= top)


def order_base_overview(base: DataFrame) -> DataFrame:
    return metrics_long(base.agg(F.count("*").alias("orders"), F.count_distinct("user_id").alias("users"), F.count_distinct("station_id").alias("stations"), F.count_if("is_valid").alias("valid_orders"), F.count_if("is_risk").alias("risk_orders"), F.count_if("is_zero").alias("zero_orders")))


def user_overview(wide: DataFrame) -> DataFrame:
    return metrics_long(wide.agg(F.count("*").alias("users"), F.sum("n_orders").alias("orders"), F.max("n_orders").alias("most_orders"), F.count_if(F.col("n_orders") == 1).alias("single_order_users")))


def final_overview(profile: DataFrame) -> DataFrame:
    return metrics_long(profile.agg(F.count("*").alias("users"), F.count_distinct("rfm_type").alias("rfm_types"), F.count_distinct("behavior_pattern").alias("patterns"), F.count_if(F.col("rfm_type") == V.HV_ACTIVE).alias("high_value_active")))


def hv_price_behaviour(segments: DataFrame) -> DataFrame:
    """High-value users by coupon use and valley share, in three steps each."""
    step = lambda c: S.chain([(F.col(c) >= 0.5, "高"), (F.col(c) >= 0.2, "中")], "低")
    rows = segments.where(F.col("rfm_type").isin(V.HV_ACTIVE, V.HV_RISK))
    return rows.groupBy(step("share_used_discount").alias("coupon"), step("avg_valley_share").alias("valley")).agg(F.count("*").alias("users"), S.round_n(F.avg("avg_kwh"), 4).alias("avg_kwh"))
