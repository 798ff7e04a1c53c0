"""The tables behind the usual order reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import values as V
from ..functions import scalars as S
from .cleaning import metrics_long


def valid_orders(orders: DataFrame) -> DataFrame:
    """Valid orders with the columns that the reports group by."""
    rows = orders.where(S.is_yes(F.col("is_valid")))
    minutes = S.round_n(S.seconds_between(F.col("start_ts"), F.col("end_ts")) / 60.0, 3)
    rows = rows.withColumns({"duration_min": minutes, "start_hour": F.hour("start_ts"), "weekday": S.weekday_name(F.col("start_ts")), "short_period": S.short_period(F.hour("start_ts")), "year": F.year("start_ts")})
    return rows.withColumns({"duration_detail": S.duration_detail_group(F.col("duration_min")), "duration_core": S.duration_core_group(F.col("duration_min")), "energy_type": S.energy_duration_type(F.col("duration_min"), F.col("energy_kwh"))})


def spine(df: DataFrame, **values) -> DataFrame:
    out = df.sparkSession.range(1).select()
    for name, items in values.items():
        out = out.select("*", F.explode(F.array(*[F.lit(x) for x in items])).alias(name))
    return out


def crosstab(df: DataFrame, row: str, col: str, rows, cols) -> DataFrame:
    """Counts in long form over the whole fixed grid, zero where nothing is."""
    got = df.groupBy(row, col).agg(F.count("*").alias("n"))
    return spine(df, **{row: rows, col: cols}).join(got, [row, col], "left").na.fill(0, ["n"])


def crosstab_wide(df: DataFrame, row: str, col: str, rows, cols) -> DataFrame:
    got = df.groupBy(row).pivot(col, list(cols)).agg(F.count(F.lit(1)))
    return spine(df, **{row: rows}).join(got, row, "left").na.fill(0)


def with_total_row(df: DataFrame, group: str, *aggregates: Column, keep=None) -> DataFrame:
    """Groups and one row 总体 over all, by grouping sets."""
    rows = df.where(F.col(group).isNotNull())
    out = rows.groupingSets([[F.col(group)], []], F.col(group)).agg(*aggregates, F.grouping_id().alias("_g"))
    return out.withColumn(group, F.when(F.col("_g") > 0, F.lit(V.TOTAL)).otherwise(F.col(group))).drop("_g")


def trend(df: DataFrame, unit: str) -> DataFrame:
    """Orders by day or month, in all (year null) and per year."""
    period = F.date_trunc(unit, "start_ts").cast("date").alias("period")
    rows = df.select(period, F.year("start_ts").alias("year"))
    return rows.groupingSets([[F.col("period"), F.col("year")], [F.col("period")]], F.col("period"), F.col("year")).agg(F.count("*").alias("orders"))


def histogram(df: DataFrame, label: Column, labels, name: str) -> DataFrame:
    got = df.groupBy(label.alias(name)).agg(F.count("*").alias("n"))
    return spine(df, **{name: labels}).join(got, name, "left").na.fill(0, ["n"])


def left_closed(x: Column, edges: list[float]) -> Column:
    """Number of the left-closed bin [edge, next); the last one holds its right edge too; null outside."""
    last = len(edges) - 2
    return S.chain([(x.isNull() | (x < edges[0]) | (x > edges[-1]), None), *((x < hi, k) for k, hi in enumerate(edges[1:-1]))], last).cast("int")


def hour_hist(df: DataFrame) -> DataFrame:
    return histogram(df, F.hour("start_ts"), range(24), "hour")


SLICES = 44  #: bits of a 60-bit draw below its slice: 65,536 slices in a group


def bounded_random_sample(df: DataFrame, group: str, key: str, k: int = 200_000, seed: int = 42) -> DataFrame:
    """At most k rows per group, those with the smallest hash of key and seed: the same rows at every run.

    Rows are counted by slice of the hash; below the slice in which the k-th row lies all stay, and only the rows of that slice, a
    65,536th of the group, are ranked. No task sorts a group, whatever k. Rows with one key follow one another in any order.
    """
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), 1, 15), 16, 10).cast("long")
    rows = df.withColumn("_draw", draw).withColumn("_slice", F.shiftright("_draw", SLICES))
    counts = rows.groupBy(F.col(group).alias("_group"), "_slice").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_group").orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0))
    edge = counts.withColumn("_upto", upto).where(F.col("_upto") > k).groupBy("_group").agg(F.min("_slice").alias("_edge"), (F.lit(k) - F.min(F.col("_upto") - F.col("_n"))).alias("_room"))
    near = rows.join(edge, F.col(group).eqNullSafe(F.col("_group")), "left")
    sure = near.where("_edge IS NULL OR _slice < _edge")
    w = Window.partitionBy(group).orderBy("_draw", key)
    ranked = near.where("_slice = _edge").withColumn("_rank", F.row_number().over(w)).where("_rank <= _room").drop("_rank")
    return sure.unionByName(ranked).drop("_draw", "_slice", "_group", "_edge", "_room")


def valley_density(df: DataFrame, bins: int = 50, total: bool = False) -> DataFrame:
    """Density of the valley share per category, and where total is set also 总体 over all, counted over all rows."""
    bin_ = F.least(F.floor(F.col("valley_share") * bins), F.lit(bins - 1)).cast("int").alias("bin")
    rows = df.where("valley_share BETWEEN 0 AND 1").select("station_category", bin_)
    by = [F.col("station_category"), F.col("bin")]
    if total:
        counts = rows.groupingSets([by, [F.col("bin")]], *by).agg(F.count("*").alias("n"), F.grouping("station_category").alias("_g"))
        counts = counts.withColumn("station_category", F.when(F.col("_g") > 0, F.lit(V.TOTAL)).otherwise(F.col("station_category"))).drop("_g")
    else:
        counts = rows.groupBy(*by).agg(F.count("*").alias("n"))
    return counts.withColumn("density", S.round_n(F.col("n") * bins / F.sum("n").over(Window.partitionBy("station_category")), 6))


def valley_kde(df: DataFrame, grid: int = 21, bandwidth: float = 0.05) -> DataFrame:
    """Gaussian kernel density on a fixed grid, from counts per hundredth (the rows meet the grid as at most 101 values)."""
    counts = df.where("valley_share BETWEEN 0 AND 1").groupBy(S.round_n("valley_share", 2).alias("v")).agg(F.count("*").alias("n"))
    points = spine(df, g=range(grid)).select((F.col("g") / (grid - 1)).alias("x"))
    kernel = F.exp(-F.pow((F.col("x") - F.col("v")) / bandwidth, F.lit(2)) / 2)
    return counts.crossJoin(F.broadcast(points)).groupBy("x").agg(S.round_n(F.sum(kernel * F.col("n")) / F.sum("n") / (bandwidth * (2 * 3.141592653589793) ** 0.5), 4).alias("density"))


def valley_curves(df: DataFrame, categories: tuple[str, ...] = V.CURVES, grid: int = 101, adjust: float = 1.1) -> DataFrame:
    """Gaussian kernel density of the valley share over all stations and for each category, each with its own bandwidth
    (``adjust`` * standard deviation * n ** -0.2). A scope of one row or one value has no density: one row with that value as x.

    All rows count; they meet the grid as at most 1001 values a scope, as shares have three places."""
    scopes = F.array_compact(F.array(F.lit(V.ALL_STATIONS), F.when(F.col("station_category").isin(*categories), F.col("station_category"))))
    rows = df.where("valley_share BETWEEN 0 AND 1").select(F.explode(scopes).alias("scope"), S.round_n("valley_share", 3).cast("decimal(4,3)").alias("v"))
    counts = rows.groupBy("scope", "v").agg(F.count("*").alias("c"))
    n, one, two = F.sum("c").cast("double"), F.sum(F.col("c") * F.col("v")).cast("double"), F.sum(F.col("c") * F.col("v") * F.col("v")).cast("double")
    spread = F.when(F.count("*") > 1, F.sqrt((two - one * one / n) / (n - 1)))
    shape = counts.groupBy("scope").agg(n.alias("n"), (spread * F.pow(n, F.lit(-0.2)) * adjust).alias("bw"))
    rows = counts.join(F.broadcast(shape), "scope").withColumn("v", F.col("v").cast("double"))
    points = F.when(F.col("bw").isNull(), F.array("v")).otherwise(F.array(*[F.lit(k / (grid - 1)) for k in range(grid)]))
    rows = rows.select("*", F.explode(points).alias("x"))
    density = F.sum(F.col("c") * F.exp(-F.pow((F.col("x") - F.col("v")) / F.col("bw"), F.lit(2)) / 2) / (F.col("n") * F.col("bw") * (2 * 3.141592653589793) ** 0.5))
    return rows.groupBy("scope", "x").agg(S.round_n(density, 4).alias("density"), S.round_n(F.first("bw"), 6).alias("bandwidth"), F.first("n").cast("long").alias("orders"))


def monthly_quantiles(df: DataFrame) -> DataFrame:
    return df.groupBy(S.year_month(F.col("start_ts")).alias("month")).agg(S.round_n(F.percentile("duration_min", 0.5), 4).alias("median_min"), S.round_n(F.percentile("duration_min", 0.75), 4).alias("p75_min"))


def category_duration_energy(df: DataFrame) -> DataFrame:
    return df.groupBy("station_category").agg(F.count("*").alias("orders"), S.round_n(F.median("duration_min"), 4).alias("median_min"), S.round_n(F.avg(F.col("energy_kwh").cast("decimal(18,3)")).cast("double"), 4).alias("avg_kwh"))


def category_reuse_rate(sequenced: DataFrame) -> DataFrame:
    rows = sequenced.where(F.col("reuse_station").isin(V.YES, V.NO))
    return with_total_row(rows, "station_category", F.count("*").alias("orders"), S.round_n(F.avg((F.col("reuse_station") == V.YES).cast("int")), 6).alias("reuse_rate"))


def category_discount_valley(df: DataFrame) -> DataFrame:
    return with_total_row(df, "station_category", F.count("*").alias("orders"), S.round_n(F.avg((F.coalesce("discount_amount", F.lit(0.0)) > 0).cast("int")), 6).alias("coupon_rate"), S.round_n(F.avg((F.coalesce("valley_share", F.lit(0.0)) >= 0.25).cast("int")), 6).alias("valley_rate"))


def top_plus_other(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n commonest values (the smaller on a tie) and one row for all others: a top-k and a join with its n rows."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), "value").limit(n).select(F.col("value").alias("_v"), F.lit(True).alias("_top"))
    named = counts.join(F.broadcast(top), F.col("value").eqNullSafe(F.col("_v")), "left")
    return named.groupBy(F.when(F.col("_top"), F.col("value")).otherwise(V.OTHER).alias("value")).agg(F.sum("n").alias("orders"))


def share_rounding(counts: DataFrame, group: list[str], n: str = "n") -> DataFrame:
    """Percentages of one decimal that sum to 100 in each group: what is missing goes to the largest cell."""
    rest = [c for c in counts.columns if c != n]
    with_all = lambda rows, one: rows.join(one, group) if group else rows.crossJoin(F.broadcast(one))
    rows = with_all(counts, counts.groupBy(*group).agg(F.sum(n).alias("_sum")))
    rows = rows.withColumn("_p", F.round(F.col(n).cast("decimal(20,0)") * 100 / F.col("_sum"), 1)).withColumn("_at", F.struct((-F.col(n)).alias("k"), *rest))
    rows = with_all(rows, rows.groupBy(*group).agg((F.lit(100) - F.sum("_p")).alias("_rest"), F.min("_at").alias("_first")))
    percent = F.col("_p") + F.when(F.col("_at") == F.col("_first"), F.col("_rest")).otherwise(0)
    return rows.withColumn("percent", percent.cast("double")).select(*counts.columns, "percent")


def drop_cross_year(df: DataFrame, source: str = "source_table") -> DataFrame:
    year = S.source_table_year(F.col(source))
    return df.where(year.isNull() | (year == F.year("start_ts")))


def min_group_size(df: DataFrame, group: Column, least: int) -> DataFrame:
    keep = df.groupBy(group.alias("_g")).count().where(F.col("count") >= least).select("_g")
    return df.withColumn("_g", group).join(keep, "_g", "left_semi").drop("_g")


def analysis_summary(df: DataFrame) -> DataFrame:
    return metrics_long(df.agg(F.count_distinct("station_category").alias("categories"), F.count_distinct(F.to_date("start_ts")).alias("days"), F.count_distinct(S.year_month(F.col("start_ts"))).alias("months")))


def monthly_tier_discount(orders: DataFrame) -> DataFrame:
    rows = orders.groupBy("user_id", S.year_month(F.col("start_ts")).alias("month")).agg(F.sum(F.col("energy_kwh").cast("decimal(18,3)")).cast("double").alias("kwh"))
    return rows.withColumn("pay_percent", S.month_discount(F.col("kwh")))


def yearly_behaviour(df: DataFrame) -> DataFrame:
    period = [S.round_n(F.avg((F.col("short_period") == p).cast("int")), 6).alias(f"share_{k}") for k, p in enumerate(V.SHORT_PERIODS)]
    return df.groupBy("year").agg(F.count("*").alias("orders"), *period, S.round_n(F.avg((F.col("discount_amount") > 0).cast("int")), 6).alias("coupon_rate"), F.count_if(F.col("end_reason_class") == V.END_FAULT).alias("fault_orders"))


def yearly_structure(df: DataFrame, fields: dict[str, str] = {"period": "short_period", "channel": "channel"}) -> DataFrame:  # noqa: B006
    """Orders and share of each value of several columns by year; blank values are unknown. One pass and one shuffle for all columns."""
    rows = df.select("year", *[S.clean_text(F.col(c), V.UNKNOWN).alias(k) for k, c in fields.items()]).unpivot(["year"], list(fields), "field", "value")
    counts = rows.groupBy("year", "field", "value").agg(F.count("*").alias("orders"))
    return counts.withColumn("share", S.round_n(F.col("orders") / F.sum("orders").over(Window.partitionBy("year", "field")), 6))


def yearly_trends(sequenced: DataFrame) -> DataFrame:
    """By year: orders, mean energy, share of orders with a discount, share of orders at the station of the order before (of those
    that have both stations)."""
    known = F.when(F.col("reuse_station").isin(V.YES, V.NO), (F.col("reuse_station") == V.YES).cast("int"))
    kwh = F.try_divide(F.sum(F.col("energy_kwh").cast("decimal(18,3)")).cast("double"), F.count("energy_kwh"))
    return sequenced.groupBy("year").agg(F.count("*").alias("orders"), S.round_n(kwh, 4).alias("avg_kwh"), S.round_n(F.avg((F.coalesce("discount_amount", F.lit(0.0)) > 0).cast("int")), 6).alias("coupon_rate"), F.count(known).alias("with_station_before"), S.round_n(F.avg(known), 6).alias("reuse_rate"))


def yearly_top_reasons(abnormal: DataFrame, n: int = 10, reason: str = "end_reason") -> DataFrame:
    """The n commonest reasons of abnormal orders by year (ties by name). Ranks are over counted reasons, not over orders."""
    counts = abnormal.groupBy(F.year("start_ts").alias("year"), S.clean_text(F.col(reason), V.UNKNOWN).alias("reason")).agg(F.count("*").alias("orders"))
    rank = F.row_number().over(Window.partitionBy("year").orderBy(F.desc("orders"), "reason"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= n)


def user_frequency_summary(df: DataFrame, many: int = 500) -> DataFrame:
    per = df.groupBy(F.year("start_ts").alias("year"), "user_id").agg(F.count("*").alias("n"))
    return per.groupBy("year").agg(F.count("*").alias("users"), F.max("n").alias("most"), F.min("n").alias("least"), S.round_n(F.avg((F.col("n") >= many).cast("int")), 6).alias("share_many"), S.round_n(F.avg((F.col("n") == 1).cast("int")), 6).alias("share_once"))


def clean_assets(station: DataFrame) -> DataFrame:
    """Asset rows with normalized key, type, place; rows without a key or of no known type left out."""
    return station.select(S.normalize_station_key(F.col("station_id")).alias("station_key"), S.normalize_station_type(F.col("station_type")).alias("station_type"), S.station_type_to_category(F.col("station_type")).alias("category"), S.normalize_category(F.col("place")).alias("place")).where("station_key IS NOT NULL AND station_type IS NOT NULL")
