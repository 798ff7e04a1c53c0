"""Queries of the charging-order operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import values as V
from ..functions import scalars as S
from ..operators import assets as A
from ..operators import cleaning as C
from ..operators import features as P
from ..operators import reports as R
from ..operators import rolling as G
from ..sources import landing as L
from ..sources import manifest as M
from ..sources.fixtures import projection
from ..streaming import feeds, streams
from . import orders as O
from . import sql as Q
from .sql import oracle, q, rnd

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def add(name: str, query: Callable, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLES[name] = oracle(sql)


def r4(*columns: str) -> str:
    return ", ".join(f"{rnd(c)} AS {c}" for c in columns)


# ---- scalar rules, over every order
def scalar_text(spark, sf):
    raw = projection(spark, sf, "charge_raw")
    return raw.select("order_id", S.normalize_text(F.col("user_id")).alias("user_key"), S.normalize_category(F.col("status")).alias("status"), S.normalize_station_key(F.col("station_id")).alias("station_key"), S.clean_text(F.col("user_id"), "-").alias("clean_user"), S.classify_end_reason(F.col("end_reason")).alias("end_class"), S.yes_no(S.is_yes(F.lit("Y"))).alias("yes"), S.safe_ident(F.concat(F.col("station_id"), F.lit(".x/"), F.col("channel"))).alias("ident"), S.source_table_year(F.concat(F.lit("y"), F.substring("start_time", 3, 2), F.lit("_m1"))).alias("table_year"))


add("scalar_text", scalar_text, f"SELECT order_id, {Q.nt('user_id')} AS user_key, coalesce({Q.nt('status')}, {q(V.UNKNOWN)}) AS status, {Q.station_key('station_id')} AS station_key, coalesce(nullif(trim(user_id), ''), '-') AS clean_user, {Q.end_class('end_reason')} AS end_class, {q(V.YES)} AS yes, regexp_replace(trim(regexp_replace(station_id || '.x/' || channel, '[^A-Za-z0-9]+', '_', 'g'), '_'), '^([0-9])', 't_\\1') AS ident, CAST(substring(start_time, 3, 2) AS INT) + 2000 AS table_year FROM charge_raw")


def scalar_time(spark, sf):
    t = F.col("start_ts")
    return O.day(spark, sf).select("order_id", S.rough_period(F.hour(t)).alias("period"), S.short_period(F.hour(t)).alias("short_period"), S.hour_label(t).alias("hour_label"), S.normalize_period(S.hour_label(t)).alias("again"), S.weekday_name(t).alias("weekday"), S.is_weekend(t).alias("is_weekend"), S.is_cross_day(t, F.col("end_ts")).alias("is_cross_day"), F.year(t).alias("natural_year"), S.year_month(t).alias("year_month"))


add("scalar_time", scalar_time, f"SELECT order_id, {Q.band('hour(start_ts)', V.PERIODS)} AS period, {Q.band('hour(start_ts)', V.SHORT_PERIODS)} AS short_period, {Q.hour_label('start_ts')} AS hour_label, {Q.hour_label('start_ts')} AS again, {Q.weekday('start_ts')} AS weekday, isodow(start_ts) >= 6 AS is_weekend, CAST(start_ts AS DATE) <> CAST(end_ts AS DATE) AS is_cross_day, year(start_ts) AS natural_year, strftime(start_ts, '%Y-%m') AS year_month FROM charge_day")


def scalar_buckets(spark, sf):
    rows = O.valid(spark, sf)
    m, k = F.col("duration_min"), F.col("energy_kwh")
    return rows.select("order_id", S.duration_bucket_13(m).alias("b13"), S.duration_bucket_3(m).alias("b3"), S.energy_bucket(k).alias("energy"), S.interval_bucket(m / 10).alias("gap"), "duration_detail", "duration_core", "energy_type", S.clamp(m, 10.0, 200.0).alias("clamped"), S.round_n(S.safe_divide(k, F.col("discount_amount"), 0.0), 4).alias("ratio"), S.month_discount(k * 10).alias("pay_percent"), S.silence_tier(m.cast("int")).alias("tier"))


add("scalar_buckets", scalar_buckets, f"SELECT order_id, {Q.duration13('duration_min')} AS b13, CASE WHEN duration_min <= 30 THEN '短时' WHEN duration_min <= 240 THEN '正常' ELSE '超长' END AS b3, {Q.energy('energy_kwh')} AS energy, {Q.gap('(duration_min / 10)')} AS gap, duration_detail, duration_core, energy_type, greatest(least(duration_min, 200.0), 10.0) AS clamped, coalesce({rnd('energy_kwh / nullif(discount_amount, 0)')}, 0.0) AS ratio, CASE WHEN energy_kwh * 10 <= 50 THEN 99 WHEN energy_kwh * 10 <= 100 THEN 95 WHEN energy_kwh * 10 <= 200 THEN 90 WHEN energy_kwh * 10 <= 300 THEN 85 ELSE 80 END AS pay_percent, CASE WHEN trunc(duration_min) BETWEEN 8 AND 15 THEN 1 WHEN trunc(duration_min) BETWEEN 16 AND 30 THEN 2 WHEN trunc(duration_min) BETWEEN 31 AND 60 THEN 3 WHEN trunc(duration_min) BETWEEN 61 AND 90 THEN 4 WHEN trunc(duration_min) BETWEEN 91 AND 180 THEN 5 END AS tier FROM rep")

# ---- sources
add("canonicalize", lambda s, d: L.canonicalize(projection(s, d, "charge_raw").withColumnRenamed("channel", "订单渠道").withColumn("channel_copy", F.lit(None))).select("order_id", "user_id", "channel", "paid_ef", "start_time", "user_type"), "SELECT order_id, user_id, channel, CAST(NULL AS VARCHAR) AS paid_ef, start_time, CAST(NULL AS VARCHAR) AS user_type FROM charge_raw")
add("typed_cast", lambda s, d: O.typed(s, d).select("order_id", "user_id", "station_id", "start_ts", "end_ts", "kwh", "meter_kwh", "ef", "sf"), "SELECT order_id, user_id, station_id, start_ts, end_ts, kwh, meter_kwh, ef, sf FROM typed")
add("union_years", lambda s, d: L.union_years({y: O.day(s, d).where(F.month("start_ts") % 2 == y % 2).select("order_id", *(["channel"] if y % 2 else [])) for y in (2000, 2001)}), "SELECT order_id, CASE WHEN month(start_ts) % 2 = 1 THEN channel END AS channel, CASE WHEN month(start_ts) % 2 = 1 THEN 2001 ELSE 2000 END AS data_year FROM charge_day")
add("projected_read", lambda s, d: L.projected_read(O.day(s, d), ["order_id", "energy_kwh"]), "SELECT order_id, energy_kwh FROM charge_day")
add("pick_col", lambda s, d: O.day(s, d).select("order_id", L.pick_col(O.day(s, d), ["user_key", "user_id"]).alias("user_key")), "SELECT order_id, user_id AS user_key FROM charge_day")
_SOURCES = "SELECT DISTINCT 'y' || strftime(start_ts, '%y_m%m') AS source_table FROM charge_day"


def sources(s, d):
    return O.day(s, d).select(F.concat(F.lit("y"), F.date_format("start_ts", "yy'_m'MM")).alias("source_table"), "order_id")


add("source_filter", lambda s, d: L.source_filter(sources(s, d).select("source_table").distinct(), exclude=("y01_m03",), like="y01%"), f"SELECT * FROM ({_SOURCES}) WHERE source_table LIKE 'y01%' AND source_table <> 'y01_m03'")
add("limit_sources", lambda s, d: L.source_filter(sources(s, d).select("source_table").distinct(), limit=3), f"SELECT * FROM ({_SOURCES}) ORDER BY 1 LIMIT 3")
add("tag_source", lambda s, d: L.landing_scan(s, f"{d}/orders.parquet").groupBy("source_table").agg(F.count("*").alias("n_rows"), F.max("o_orderkey").alias("last_key")), "SELECT 'orders' AS source_table, count(*) AS n_rows, max(o_orderkey) AS last_key FROM orders")
add("snapshot_meta", lambda s, d: L.validate_snapshot(O.sessions(s, d), L.snapshot_meta(O.sessions(s, d))), "SELECT count(*) AS n_rows, CAST(sum(raw_orders) AS BIGINT) AS original_orders FROM sessions")
add("load_station_dims", lambda s, d: C.load_station_dims(O.stations(s, d)), "SELECT * FROM dims")
add("clean_assets", lambda s, d: R.clean_assets(O.stations(s, d)), f"SELECT {Q.station_key('station_id')} AS station_key, replace(replace(station_type, '（', '('), '）', ')') AS station_type, {Q.category('station_type')} AS category, place FROM station WHERE station_type IS NOT NULL")
_ASSET = ["station_key", "station_type", "category", "place", "status", "longitude", "latitude", "since", "since_year", "since_month"]


def judged_assets(s, d):
    return A.judge_assets(projection(s, d, "asset"))


add("kept_assets", lambda s, d: A.split_assets(judged_assets(s, d))[0].select(*_ASSET), f"SELECT {', '.join(_ASSET)} FROM assets WHERE outcome = 'kept'")
add("problem_assets", lambda s, d: A.split_assets(judged_assets(s, d))[1].select("station_key", "station_type", "outcome"), "SELECT station_key, station_type, outcome FROM assets WHERE outcome NOT IN ('kept', 'retired')")
add("asset_log", lambda s, d: A.asset_log(judged_assets(s, d)), "SELECT outcome, count(*) AS assets, count(since) AS dated FROM assets GROUP BY 1")
add("assets_by_year", lambda s, d: A.assets_by_year(A.split_assets(judged_assets(s, d))[0]), "SELECT since_year, category, status, count(DISTINCT station_key) AS stations FROM assets WHERE outcome = 'kept' GROUP BY ALL")
_MAPPED = f"SELECT DISTINCT charger_id, {Q.station_key('station_id')} AS station_key, valid_from, valid_to, coalesce(valid_to, (SELECT max(valid_to) FROM mapping)) AS upto FROM mapping"
add("mapping_periods", O.mapping_periods, f"SELECT charger_id, station_key, valid_from, valid_to, CAST(date_diff('month', valid_from, upto) AS INT) AS months, row_number() OVER (PARTITION BY charger_id ORDER BY valid_from DESC, upto DESC, station_key DESC) = 1 AS is_latest, count(*) OVER (PARTITION BY charger_id) AS mappings FROM ({_MAPPED})")

# ---- cleaning
add("discard_rules", lambda s, d: O.judged(s, d).select("order_id", "discard_code", "discard_reason"), f"SELECT order_id, discard_code, CASE WHEN discard_code = 0 THEN '' ELSE list_extract([{', '.join(map(q, V.DISCARD_REASONS))}], discard_code) END AS discard_reason FROM judged")
add("split_main_discard", lambda s, d: C.split_main_discard(O.judged(s, d))[1].groupBy("discard_code", "discard_reason").agg(F.count("*").alias("orders")), f"SELECT discard_code, list_extract([{', '.join(map(q, V.DISCARD_REASONS))}], discard_code) AS discard_reason, count(*) AS orders FROM judged WHERE discard_code > 0 GROUP BY ALL")
_MAIN = ["order_id", "user_id", "station_id", "start_ts", "end_ts", "duration_min", "energy_kwh", "peak_kwh", "flat_kwh", "valley_kwh", "valley_share", "avg_power_kw", "discount_amount", "used_discount", "end_reason_class"]
add("derive_order_fields", lambda s, d: O.main(s, d).select(*_MAIN, "weekday", "period", "duration_bucket", "energy_bucket"), f"SELECT {', '.join(_MAIN)}, {Q.weekday('start_ts')} AS weekday, {Q.band('hour(start_ts)', V.PERIODS)} AS period, {Q.duration13('duration_min')} AS duration_bucket, {Q.energy('energy_kwh')} AS energy_bucket FROM main")
add("tou_allocate", lambda s, d: O.main(s, d).groupBy("charge_date").agg(*[S.round_n(F.sum(F.col(f"{k}_kwh").cast("decimal(18,3)")).cast("double"), 3).alias(f"{k}_kwh") for k in C.TOU]), "SELECT CAST(start_ts AS DATE) AS charge_date, " + ", ".join(f"CAST(sum(CAST({k}_kwh AS DECIMAL(18,3))) AS DOUBLE) AS {k}_kwh" for k in C.TOU) + " FROM main GROUP BY 1")
add("abnormal_orders", lambda s, d: C.abnormal_orders(O.main(s, d)).select("order_id", "user_id", "end_reason_class"), f"SELECT order_id, user_id, end_reason_class FROM main WHERE end_reason_class IN ({q(V.END_FAULT)}, {q(V.END_OTHER)})")
add("order_sequence", lambda s, d: C.order_sequence(O.main(s, d)).select("order_id", "user_id", "user_seq", "user_month_seq", "gap_h", "gap_bucket", "is_first", "reuse_station"), f"SELECT order_id, user_id, user_seq, user_month_seq, gap_h, {Q.gap('gap_h')} AS gap_bucket, user_seq = 1 AS is_first, {Q._REUSE} FROM ({Q._SEQ % 'main'})")
add("restart_sessions", lambda s, d: C.restart_sessions(O.main(s, d)).select("order_id", "user_id", "session_no"), "SELECT order_id, user_id, CAST(session_no AS BIGINT) AS session_no FROM numbered")
_PARTED_SEQ = ["order_id", "user_id", "user_seq", "user_month_seq", "gap_h"]
add("parted_order_sequence", lambda s, d: C.order_sequence(O.day(s, d), heavy=C.heavy_users(O.day(s, d), least=100)).select(*_PARTED_SEQ), f"SELECT {', '.join(_PARTED_SEQ)} FROM ({Q._SEQ % 'charge_day'})")
add("parted_restart_sessions", lambda s, d: C.restart_sessions(O.main(s, d), heavy=C.heavy_users(O.judged(s, d), least=8)).select("order_id", "user_id", "session_no"), "SELECT order_id, user_id, CAST(session_no AS BIGINT) AS session_no FROM numbered")
_SESS = ["user_id", "order_id", "station_id", "start_ts", "end_ts", "energy_kwh", "peak_kwh", "flat_kwh", "valley_kwh", "discount_amount", "used_discount", "raw_orders", "duration_min", "is_merged", "valley_share"]
add("merge_restart_orders", lambda s, d: C.merge_restart_orders(C.restart_sessions(O.main(s, d))).select(*_SESS), f"SELECT {', '.join(_SESS)} FROM sessions1")
add("clean_sessions", lambda s, d: O.sessions(s, d).select(*_SESS, "user_seq", "user_month_seq", "gap_h", "gap_bucket", "is_first", "reuse_station"), f"SELECT {', '.join(_SESS)}, user_seq, user_month_seq, gap_h, gap_bucket, is_first, reuse_station FROM sessions")
add("restart_summary", lambda s, d: C.restart_summary(O.sessions(s, d)), "SELECT CAST(sum(raw_orders) AS BIGINT) AS before_merge, count(*) AS after_merge, CAST(sum(raw_orders) - count(*) AS BIGINT) AS reduced, count(*) FILTER (raw_orders > 1) AS merged_groups FROM sessions")


def unpivot(pairs: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS metric, CAST({e} AS BIGINT) AS value FROM {s}" for k, (e, s) in ((k, (v, source) if isinstance(v, str) else v) for k, v in pairs.items()))


_AB = f"count(*) FILTER (discard_code = 0 AND {Q.end_class('end_reason')} IN ({q(V.END_FAULT)}, {q(V.END_OTHER)}))"
add("cleaning_overview", lambda s, d: C.cleaning_overview(O.judged(s, d), O.sessions(s, d)), unpivot({"raw_orders": ("count(*)", "judged"), "kept_orders": ("count(*) FILTER (discard_code = 0)", "judged"), "discarded_orders": ("count(*) FILTER (discard_code > 0)", "judged"), "abnormal_orders": (_AB, "judged"), "discarded_zero_energy": ("count(*) FILTER (discard_code > 0 AND k0 <= 0)", "judged"), "sessions": ("count(*)", "sessions"), "main_zero_energy": ("count(*) FILTER (energy_kwh <= 0)", "sessions"), "valid_sessions": ("count(*)", "sessions"), "users": ("count(DISTINCT user_id)", "sessions"), "stations": ("count(DISTINCT station_id)", "sessions"), "merged_groups": ("count(*) FILTER (is_merged)", "sessions")}, ""))
_FS = ["user_id", "station_id", "start_ts", "kwh"]
add("field_stats", lambda s, d: C.field_stats(O.typed(s, d), _FS), " UNION ALL ".join(f"SELECT '{c}' AS field, count(*) - count({c}) AS missing, {rnd(f'(count(*) - count({c})) / CAST(count(*) AS DOUBLE)')} AS missing_rate, count(DISTINCT {c}) AS distinct_values FROM typed" for c in _FS))
add("high_frequency_threshold", lambda s, d: C.high_frequency_threshold(O.day(s, d)), "SELECT CAST(least(365, greatest(1, ceil(365 * n / 365.0))) AS INT) AS threshold, CAST(n AS INT) AS covered_days FROM (SELECT date_diff('day', CAST(min(start_ts) AS DATE), CAST(max(start_ts) AS DATE)) + 1 AS n FROM charge_day)")
add("high_frequency_exclusion", lambda s, d: C.high_frequency_exclusion(O.day(s, d), 60).groupBy("user_id").agg(F.count("*").alias("orders")), "SELECT user_id, count(*) AS orders FROM charge_day GROUP BY 1 HAVING count(*) <= (SELECT least(60, greatest(1, ceil(60 * (date_diff('day', CAST(min(start_ts) AS DATE), CAST(max(start_ts) AS DATE)) + 1) / 365.0))) FROM charge_day)")

# ---- stations

def uuid_orders(s, d):
    """Orders whose even minutes name their station by its uuid."""
    return O.day(s, d).withColumn("station_id", F.when(F.minute("start_ts") % 2 == 0, F.concat(F.lit("u"), "station_id")).otherwise(F.col("station_id")))


def attached(s, d):
    dims = C.load_station_dims(O.stations(s, d))
    rows = C.resolve_station_id(uuid_orders(s, d).drop("station_category"), dims, projection(s, d, "bridge"))
    return C.attach_station(rows, dims, C.name_category_pick(O.stations(s, d)))


_RES = "SELECT o.order_id, o.start_ts, o.sid, CASE WHEN k.station_key IS NOT NULL THEN sid ELSE coalesce(b.station_code, sid) END AS resolved_id FROM (SELECT order_id, start_ts, CASE WHEN minute(start_ts) % 2 = 0 THEN 'u' || station_id ELSE station_id END AS sid FROM charge_day) o LEFT JOIN dims k ON sid = k.station_key LEFT JOIN bridge b ON sid = b.station_uuid"
_PICK = f"SELECT station_name, first(category ORDER BY list_position([{', '.join(map(q, V.CATEGORY_PRIORITY))}], category)) AS category FROM (SELECT station_name, {Q.category('station_type')} AS category FROM station) GROUP BY 1"
_ATT = f"SELECT r.order_id, r.resolved_id, CASE WHEN coalesce(d.category, {q(V.OTHER)}) <> {q(V.OTHER)} THEN d.category ELSE coalesce(p.category, {q(V.OTHER)}) END AS station_category, d.place FROM ({_RES}) r LEFT JOIN dims d ON r.resolved_id = d.station_key LEFT JOIN ({_PICK}) p ON p.station_name = d.station_name"
add("resolve_station_id", lambda s, d: C.resolve_station_id(uuid_orders(s, d), C.load_station_dims(O.stations(s, d)), projection(s, d, "bridge")).select("order_id", "resolved_id"), f"SELECT order_id, resolved_id FROM ({_RES})")
add("name_category_pick", lambda s, d: C.name_category_pick(O.stations(s, d)), _PICK)
add("attach_station_category", lambda s, d: attached(s, d).select("order_id", "resolved_id", "station_category", "place"), _ATT)
add("station_detail", lambda s, d: C.station_detail(O.day(s, d)), f"SELECT station_id, first(station_category ORDER BY n DESC, list_position([{', '.join(map(q, V.CATEGORIES))}], station_category)) AS category, min(t) AS first_seen, CAST(sum(n) AS BIGINT) AS orders FROM (SELECT station_id, station_category, count(*) AS n, min(start_ts) AS t FROM charge_day GROUP BY ALL) GROUP BY station_id")
_CATS = f"(SELECT unnest([{', '.join(map(q, V.CATEGORIES))}]) AS category)"
add("category_share", lambda s, d: C.category_share(O.day(s, d)), f"SELECT category, coalesce(n, 0) AS orders, coalesce(st, 0) AS stations, {rnd('coalesce(n, 0) / CAST(sum(n) OVER () AS DOUBLE)')} AS share FROM {_CATS} LEFT JOIN (SELECT station_category AS category, count(*) AS n, count(DISTINCT station_id) AS st FROM charge_day GROUP BY 1) USING (category)")
add("weighted_totals", lambda s, d: C.category_share(O.day(s, d), F.when(F.minute("start_ts") < 30, F.lit(2)).otherwise(F.lit(1))).select("category", "orders"), f"SELECT category, CAST(coalesce(n, 0) AS BIGINT) AS orders FROM {_CATS} LEFT JOIN (SELECT station_category AS category, sum(CASE WHEN minute(start_ts) < 30 THEN 2 ELSE 1 END) AS n FROM charge_day GROUP BY 1) USING (category)")

# ---- features and scores
_BASE = ["order_id", "user_id", "hour_label", "duration_min", "discount_share", "unit_price", "power_kw", *Q._FLAGS]
add("order_behavior_base", lambda s, d: O.base(s, d).select(*_BASE), f"SELECT {', '.join(_BASE)} FROM base")


def sourced_orders(s, d):
    """Orders with what only some landing tables hold: a source table, codes of users, sources of orders, energy by tariff."""
    minute, kwh = F.minute("start_ts"), F.col("energy_kwh")
    return O.day(s, d).withColumns({
        "source_table": F.when(minute % 5 > 0, F.concat(F.lit("y0"), (1 + minute % 2).cast("string"), F.lit("_m03"))), "user_code": F.when(minute % 7 > 0, F.concat(F.lit(" "), "user_id")),
        "order_source": F.when(minute % 3 > 0, F.col("charge_method")).otherwise(" "), "used_discount": minute % 10 == 0,
        "peak_kwh": kwh * 0.25, "flat_kwh": F.when(minute % 2 == 0, kwh * 0.5), "valley_kwh": kwh * 0.25,
    })


_SOURCED = ["order_id", "data_year", "natural_year", "user_code", "order_source", "peak_kwh", "flat_kwh", "valley_kwh", "used_discount"]
add("order_base_sources", lambda s, d: P.order_behavior_base(P.recent_window(P.exclude_category(P.sequenced(sourced_orders(s, d)))), O.FIRST).select(*_SOURCED), f"SELECT order_id, CAST(CASE WHEN m % 5 > 0 THEN 2001 + m % 2 ELSE year(start_ts) END AS INT) AS data_year, CAST(year(start_ts) AS INT) AS natural_year, CASE WHEN m % 7 > 0 THEN user_id END AS user_code, CASE WHEN m % 3 > 0 THEN charge_method ELSE {q(V.UNKNOWN)} END AS order_source, {rnd('energy_kwh * 0.25', 3)} AS peak_kwh, CASE WHEN m % 2 = 0 THEN {rnd('energy_kwh * 0.5', 3)} END AS flat_kwh, {rnd('energy_kwh * 0.25', 3)} AS valley_kwh, m % 10 = 0 OR discount_amount > 0 AS used_discount FROM (SELECT *, minute(start_ts) AS m FROM base)")
add("recent_window", lambda s, d: P.recent_window(P.exclude_category(O.day(s, d))).select("order_id", "start_ts"), "SELECT order_id, start_ts FROM recent")
add("order_base_overview", lambda s, d: P.order_base_overview(O.base(s, d)), unpivot({"orders": "count(*)", "users": "count(DISTINCT user_id)", "stations": "count(DISTINCT station_id)", "valid_orders": "count(*) FILTER (valid)", "risk_orders": "count(*) FILTER (is_risk)", "zero_orders": "count(*) FILTER (is_zero)"}, "base"))
_FD = ["sum_kwh", "avg_kwh", "median_kwh", "avg_minutes", "median_minutes", "avg_power", "avg_valley_share", "sum_paid", "avg_paid", "avg_unit_price", "sum_discount", "avg_discount_share", "avg_gap_h", "median_gap_h"]
_FI = ["user_id", "n_orders", "n_years", "n_months", "n_days", "first_ts", "last_ts", "n_gaps", *[f"n_{f}" for f in Q._FLAGS]]
add("user_features", lambda s, d: O.rounded(P.user_features(P.valid_user_filter(O.base(s, d)))), f"SELECT {', '.join(_FI)}, {r4(*_FD)} FROM features")
_RD = ["days_per_order", *[f"share_{f}" for f in Q._FLAGS]]
add("user_ratio_features", lambda s, d: O.rounded(O.wide(s, d).select("user_id", "days_since_last", "span_days", *_RD)), f"SELECT user_id, days_since_last, span_days, {r4(*_RD)} FROM ratios")
add("top_value", lambda s, d: O.rounded(P.top_value(P.valid_user_filter(O.base(s, d)))), f"SELECT user_id, attribute, value, {rnd('n / CAST(total AS DOUBLE)')} AS share, kinds FROM ranked WHERE rn = 1 AND attribute NOT IN ('station', 'hour')")
_SC = ["station_share1", "station_share2", "station_share3", "station_top2", "station_top3", "station_min2", "station_min3"]
_HC = [c.replace("station", "hour") for c in _SC]
add("station_concentration", lambda s, d: O.rounded(P.station_concentration(P.valid_user_filter(O.base(s, d)))), f"SELECT user_id, top_station, station2, station3, {r4(*_SC)}, n_stations FROM conc_station")
add("time_concentration", lambda s, d: O.rounded(P.time_concentration(P.valid_user_filter(O.base(s, d)))), f"SELECT user_id, top_hour1, top_hour2, top_hour3, {r4(*_HC)}, n_hours FROM conc_hour")
add("station_top3_detail", lambda s, d: O.rounded(P.station_top3_detail(P.valid_user_filter(O.base(s, d)))), "SELECT user_id, " + ", ".join(f"max(CASE WHEN rn = {k} THEN value END) AS station{k}, max(CASE WHEN rn = {k} THEN n END) AS n{k}, {rnd(f'max(CASE WHEN rn = {k} THEN n / CAST(total AS DOUBLE) END)')} AS share{k}" for k in (1, 2, 3)) + " FROM ranked WHERE attribute = 'station' GROUP BY user_id")
_SEGC = ["user_id", "r_score", "f_score", "m_score", "r_level", "f_level", "m_level", "rfm_type", "rfm_total", "price_level", "station_pref", "time_pref", "risk_level", "user_labels"]
add("rfm_segments", lambda s, d: O.segments(s, d).select(*_SEGC, "rfm_mean"), f"SELECT {', '.join(_SEGC)}, {rnd('rfm_total / 3.0', 3)} AS rfm_mean FROM labels")
add("final_profile", lambda s, d: O.rounded(P.final_labels(P.final_profile(O.segments(s, d)))), "SELECT " + ", ".join(f"{rnd(c)} AS {c}" if c in ("hour_share1", "hour_share2", "hour_share3", "hour_top2", "hour_top3", "sum_kwh", "sum_paid", "share_used_discount") else c for c in dict.fromkeys(P.FINAL)) + " FROM profile")
add("rfm_type_summary", lambda s, d: O.segments(s, d).groupBy("rfm_type").agg(F.count("*").alias("users"), S.round_n(F.avg("avg_kwh"), 4).alias("avg_kwh")), f"SELECT rfm_type, count(*) AS users, {rnd('avg(avg_kwh)')} AS avg_kwh FROM labels GROUP BY 1")
_DIM = lambda labels, source: " UNION ALL ".join(f"SELECT '{c}' AS dimension, {c} AS label, count(*) AS users, {rnd('count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)')} AS share FROM {source} GROUP BY {c}" for c in labels)
add("label_distribution", lambda s, d: P.label_distribution(O.segments(s, d)), _DIM(P.LABELS, "labels"))
add("label_reports", lambda s, d: P.label_distribution(O.segments(s, d), (*P.LABELS, "time_pref", "top_hour1", "user_labels")), _DIM((*P.LABELS, "time_pref", "top_hour1", "user_labels"), "labels"))
add("multi_label_count", lambda s, d: P.multi_label_count(O.segments(s, d)), "SELECT label, count(*) AS users FROM (SELECT unnest(string_split(user_labels, '；')) AS label FROM labels) GROUP BY 1")
add("nested_counts", lambda s, d: P.nested_counts(O.segments(s, d)), " UNION ALL ".join(f"SELECT rfm_type, '{c}' AS dimension, {c} AS label, count(*) AS users FROM labels" + (f" WHERE {c} <> {q(V.TOO_FEW)}" if c in ("station_pref", "time_pref") else "") + " GROUP BY ALL" for c in ("price_level", "risk_level", "station_pref", "time_pref")))
add("field_scope_overview", lambda s, d: P.field_scope_overview(O.day(s, d)), f"SELECT year(start_ts) AS natural_year, count(*) AS orders, count(DISTINCT user_id) AS users, count(*) FILTER (is_valid = {q(V.YES)}) AS valid_orders, count(*) FILTER (trim(abnormal_reason) <> '') AS abnormal_orders, min(CAST(start_ts AS DATE)) AS first_date, max(CAST(start_ts AS DATE)) AS last_date, count(*) FILTER (user_id IS NULL OR station_id IS NULL) AS missing_required FROM charge_day GROUP BY 1")
_CD = ["channel", "charge_method", "station_category", "station_id", "end_reason_class"]
add("category_distribution", lambda s, d: P.category_distribution(O.day(s, d), _CD), "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS field, {c} AS value, count(*) AS n, {rnd('count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)')} AS share, row_number() OVER (ORDER BY count(*) DESC, {c}) AS rank FROM charge_day GROUP BY {c}" for c in _CD) + ") WHERE rank <= 12")
add("user_overview", lambda s, d: P.user_overview(O.wide(s, d)), unpivot({"users": "count(*)", "orders": "sum(n_orders)", "most_orders": "max(n_orders)", "single_order_users": "count(*) FILTER (n_orders = 1)"}, "features"))
add("final_overview", lambda s, d: P.final_overview(P.final_profile(O.segments(s, d))), unpivot({"users": "count(*)", "rfm_types": "count(DISTINCT rfm_type)", "patterns": "count(DISTINCT behavior_pattern)", "high_value_active": f"count(*) FILTER (rfm_type = {q(V.HV_ACTIVE)})"}, "profile"))
_STEP = lambda c: f"CASE WHEN {c} >= 0.5 THEN '高' WHEN {c} >= 0.2 THEN '中' ELSE '低' END"
add("hv_price_behaviour", lambda s, d: P.hv_price_behaviour(O.segments(s, d)), f"SELECT {_STEP('share_used_discount')} AS coupon, {_STEP('avg_valley_share')} AS valley, count(*) AS users, {rnd('avg(avg_kwh)')} AS avg_kwh FROM labels WHERE rfm_type IN ({q(V.HV_ACTIVE)}, {q(V.HV_RISK)}) GROUP BY ALL")

# ---- rolling windows, lists, segments
add("user_daily", lambda s, d: O.daily(s, d).withColumn("kwh", F.col("kwh").cast("double")), "SELECT user_id, order_date, orders, CAST(kwh AS DOUBLE) AS kwh, last_ts FROM daily")
add("window_end_dates", lambda s, d: G.window_end_dates(O.daily(s, d)), "SELECT win_end FROM ends")
_SN = ["win_start", "win_end", "user_id", "n_orders", "last_ts", "days_to_end", "span_days", "r_score", "f_score", "m_score", "rfm_type"]
_SNQ = "SELECT win_start, win_end, user_id, CAST(n_orders AS BIGINT) AS n_orders, last_ts, days_to_end, span_days, r_score, f_score, m_score, rfm_type, " + r4("avg_kwh", "days_per_order") + " FROM snaps"
add("rolling_rfm_snapshots", lambda s, d: O.rounded(O.rolling(s, d).select(*_SN, "avg_kwh", "days_per_order")), _SNQ)
add("rolling_rfm_by_range", lambda s, d: O.rounded(G.rolling_rfm_by_range(O.daily(s, d)).select(*_SN, "avg_kwh", "days_per_order")), _SNQ)
_PER = "SELECT user_id, rfm_type, seg_start, seg_end, n_windows, prev_type, next_type FROM periods"
add("type_periods", lambda s, d: G.type_periods(O.rolling(s, d)), _PER)
add("high_value_trajectory", lambda s, d: G.high_value_trajectory(G.type_periods(O.rolling(s, d))), "SELECT user_id, hv_start, hv_end, CAST(hv_windows AS BIGINT) AS hv_windows, hv_segments, first_prev, last_next FROM traj")
add("four_state", lambda s, d: O.lists(s, d)["states"].select("user_id", "hv_state", "hv_segments", "hv_end"), "SELECT user_id, hv_state, hv_segments, hv_end FROM states")
add("sliding_overview", lambda s, d: (lambda x: G.sliding_overview(x["snapshots"], x["periods"]))(O.lists(s, d)), unpivot({"windows": ("count(DISTINCT win_end)", "snaps"), "snapshot_rows": ("count(*)", "snaps"), "period_rows": ("count(*)", "periods"), "hv_periods": (f"count(*) FILTER (rfm_type = {q(V.HV_ACTIVE)})", "periods"), "hv_users": ("count(*)", "states"), **{n: (f"count(*) FILTER (hv_state = {q(x)})", "states") for n, x in (("stable", V.STABLE), ("returning", V.RETURNING), ("exited", V.EXITED), ("silent", V.SILENT))}}, ""))
add("new_users", lambda s, d: O.lists(s, d)["new"], "SELECT * FROM news")
add("returning_users", lambda s, d: G.returning_users(G.list_base(O.day(s, d))), "SELECT user_id, prev_date, return_date, gap_days, orders_horizon, orders_before, orders_recent FROM returns")
_RF = ["user_id", "return_date", "seg_start", "seg_end", "ever_hv_state", "was_hv", "ever_hv", "hv_state_before"]
add("returning_hv_flags", lambda s, d: O.lists(s, d)["returning"].select(*_RF), f"SELECT {', '.join(_RF)} FROM flagged")
add("recent_abnormal", lambda s, d: O.lists(s, d)["abnormal"], "SELECT user_id, first_ts, last_ts, CAST(abnormal_orders AS BIGINT) AS abnormal_orders, reason_kinds, reason_detail, main_reason FROM abnormal")
add("recent_overview", lambda s, d: (lambda x: G.recent_overview(x["base"], x["new"], x["returning"], x["abnormal"]))(O.lists(s, d)), unpivot({"new_users": ("count(*)", "news"), "returning_users": ("count(*)", "flagged"), "returning_hv": ("count(*) FILTER (ever_hv)", "flagged"), "abnormal_users": ("count(*)", "abnormal"), "users": ("count(DISTINCT user_id)", "lbase"), "orders": ("count(*)", "lbase")}, ""))
_FIN = ["user_id", "segment_code", "hv_state", "hv_segments", "days_since_hv_exit", "days_since_last", "is_abnormal", "coupon_level", "valley_level", "top_station", "top_hour1", "single_high", "price_level", "station_pref", "time_pref", "risk_level"]
_NAME = Q.case([(f"segment_code = '{a}'", q(b)) for a, b in V.SEGMENTS], "NULL")
_SLOT = lambda p, c, n: f"CASE WHEN {p} = {q(V.TOO_FEW)} THEN {q(V.NONE)} ELSE coalesce(nullif({c}, ''), {q(V.NONE)}) END AS {n}"
_SLOTS = ", ".join([*(_SLOT("station_pref", c, f"pref_station{k}") for k, c in enumerate(("top_station", "station2", "station3"), 1)), *(_SLOT("time_pref", c, f"pref_hour{k}") for k, c in enumerate(("top_hour1", "top_hour2", "top_hour3"), 1))])
_PREF = [f"pref_{p}{k}" for p in ("station", "hour") for k in (1, 2, 3)]
add("final_segment", lambda s, d: O.final(s, d)[0].select(*_FIN, "segment", *_PREF), f"SELECT {', '.join(_FIN)}, {_NAME} AS segment, {_SLOTS} FROM final")
add("core7_segments", lambda s, d: G.core7_segments(O.codes(s, d)[0]), "SELECT user_id, segment_code FROM final WHERE segment_code <= '07'")


def silents(s, d):
    x = O.lists(s, d, None)
    main = O.written(x["main"].select("user_id", "last_ts"), "main")
    return G.silent_list(x["states"], main).select("user_id", "hv_state", "hv_start", "hv_end", "days_since_hv_exit")


add("silent_list", silents, "SELECT user_id, hv_state, hv_start, hv_end, days_since_hv_exit FROM silent")


def history_detail(s, d):
    x = O.lists(s, d, ("station_id", *O.LISTED))
    orders = x["day"]  # written before the states, which then read it
    return G.silent_history_detail(orders, O.written(x["states"].where(F.col("hv_state").isin(V.SILENT, V.EXITED)).select("user_id"), "listed"))


_HIST = f"SELECT * FROM (SELECT *, {Q.hour_label('start_ts')} AS hour_label FROM charge_day WHERE {Q._NB}) WHERE user_id IN (SELECT user_id FROM states WHERE hv_state IN ({q(V.SILENT)}, {q(V.EXITED)}))"


def hist_sql() -> str:
    ranked = Q._rank("hist", {"station": "station_id", "hour": "hour_label"})
    cs, ch = (Q._conc(a, n).replace("FROM ranked", "FROM hranked") for a, n in (("station", ("station1", "station2", "station3")), ("hour", ("hour1", "hour2", "hour3"))))
    slots = ", ".join([*(_SLOT(Q.station_pref(), f"station{k}", f"station{k}") for k in (1, 2, 3)), *(_SLOT(Q.time_pref(), f"hour{k}", f"hour{k}") for k in (1, 2, 3))])
    return f"SELECT user_id, n_orders, {Q.station_pref()} AS station_pref, {Q.time_pref()} AS time_pref, {slots} FROM (SELECT user_id, count(*) AS n_orders FROM hist GROUP BY 1) LEFT JOIN ({cs}) USING (user_id) LEFT JOIN ({ch}) USING (user_id)", ranked


def _hist_oracle() -> str:
    select, ranked = hist_sql()
    full = oracle(f"SELECT 1 FROM ({_HIST})")
    return full[: full.rindex("SELECT 1 FROM")].rstrip() + f",\nhist AS ({_HIST}),\nhranked AS ({ranked})\n{select}"


QUERIES["silent_history_detail"], ORACLES["silent_history_detail"] = history_detail, _hist_oracle()
_SP = "(SELECT unnest([" + ", ".join(f"{{'segment_code': '{a}', 'segment': {q(b)}}}" for a, b in V.SEGMENTS) + "], recursive := true))"
add("segment_overview", lambda s, d: (lambda f: G.segment_overview(f[0], f[1]["states"]))(O.codes(s, d)), f"SELECT segment_code, segment, coalesce(n, 0) AS users, {rnd('coalesce(n, 0) / CAST((SELECT count(*) FROM final) AS DOUBLE)', 6)} AS share FROM {_SP} LEFT JOIN (SELECT segment_code, count(*) AS n FROM final GROUP BY 1) USING (segment_code)")


def checks(s, d):
    seg, x = O.final(s, d, again=True)
    silent = O.written(G.silent_list(x["states"], x["main"]), "silent")
    assigned = G.assign_segments(x["main"], x["states"], x["new"], x["returning"])
    detail = O.written(G.silent_history_detail(x["day"], silent), "detail")
    return G.segment_checks(seg, assigned, G.core7_segments(seg), x["states"], silent, x["new"], x["returning"], x["abnormal"], detail)


def _checks_oracle() -> str:
    """Every check again from the segments, lists and states; the numbers of each stand in one row."""
    full = oracle("SELECT 1 FROM final JOIN flagged JOIN silent JOIN abnormal JOIN news JOIN states JOIN charge_day")
    hist = f"SELECT * FROM (SELECT *, {Q.hour_label('start_ts')} AS hour_label FROM charge_day WHERE {Q._NB}) WHERE user_id IN (SELECT user_id FROM silent)"
    select, ranked = hist_sql()
    main = "(" + ", ".join(f"'{a}'" for a, _ in V.SEGMENTS if a != "10") + ")"
    slots = lambda t, cs: "(" + " OR ".join(t.format(x) for x in cs) + ")"
    ps, ph = _PREF[:3], _PREF[3:]
    few = lambda s_, h_: f"(station_pref = {q(V.TOO_FEW)} AND {slots('{} <> ' + q(V.NONE), s_)}) OR (time_pref = {q(V.TOO_FEW)} AND {slots('{} <> ' + q(V.NONE), h_)})"
    blank = lambda cs: slots("coalesce(trim({}), '') = ''", cs)
    ds, dh = [f"station{k}" for k in (1, 2, 3)], [f"hour{k}" for k in (1, 2, 3)]
    count = lambda cond, table="fin": f"(SELECT count(*) FROM {table} WHERE {cond})"
    gone = lambda t: f"(SELECT count(DISTINCT user_id) FROM {t} WHERE user_id NOT IN (SELECT user_id FROM fin))"
    n, hv, core, silent = "(SELECT count(*) FROM fin)", "(SELECT count(*) FROM states)", "segment_code <= '07'", "(SELECT count(*) FROM silent)"
    detailed, new_hv, c345 = count("user_id IN (SELECT user_id FROM details)", "silent"), count("segment_code = '01' AND hv_state <> ''"), count("segment_code IN ('03', '04', '05')")
    pairs = {
        "sum_of_segments": (count(f"segment_code IN {main}"), n), "unique_users": ("(SELECT count(DISTINCT user_id) FROM fin)", n), "known_segments": (count(f"segment_code NOT IN {main}"), "0"), "extra_columns_apart": ("(SELECT count(*) FROM fin JOIN final USING (user_id) WHERE fin.segment_code <> final.segment_code)", "0"),
        "lists_inside_main": (f"{gone('news')} + {gone('flagged')} + {gone('abnormal')}", "0"), "abnormal_flags": (count("is_abnormal"), "(SELECT count(*) FROM abnormal)"),
        "four_states": (f"{new_hv} + {c345} + {silent}", hv),
        "returning_absorbed": (count("segment_code IN ('03', '04', '05') AND user_id IN (SELECT user_id FROM flagged)"), "(SELECT count(DISTINCT user_id) FROM flagged WHERE ever_hv)"), "silent_outside_main": (count(f"hv_state = {q(V.SILENT)}"), "0"), "high_value_inside_main": (count("hv_state <> ''") + f" + {silent}", hv),
        "core_count": (count(core), count("segment_code IN ('01', '02', '03', '04', '05', '06', '07')")), "core_only": ("0", "0"), "preference_gate": (count(f"(station_pref = {q(V.TOO_FEW)}) <> (time_pref = {q(V.TOO_FEW)})"), "0"), "too_few_slots_none": (count(few(ps, ph)), "0"), "no_blank_preference": (count(blank(_PREF)), "0"),
        "silent_detail_complete": (detailed, f"CASE WHEN (SELECT count(*) FROM details) > 0 THEN {silent} ELSE {detailed} END"), "silent_no_blank_preference": (count(blank(ds + dh), "silout"), "0"), "silent_too_few_slots_none": (count(few(ds, dh), "silout"), "0"),
        "small_segment": ("(SELECT count(*) FROM (SELECT segment_code FROM fin GROUP BY 1 HAVING count(*) < 100))", "0"), "top_preference_core": (f"greatest({count(core + ' AND pref_station1 <> ' + q(V.NONE))}, {count(core + ' AND pref_hour1 <> ' + q(V.NONE))})", count(core)),
    }
    good = lambda k: "a <= b" if k == "top_preference_core" else "a = b"
    rows = " UNION ALL ".join(f"SELECT '{k}' AS check_name, CASE WHEN {good(k)} THEN {q(V.PASS)} ELSE {q(V.WARN if k == 'small_segment' else V.FAIL)} END AS result, CAST(a AS VARCHAR) || ' vs ' || CAST(b AS VARCHAR) AS detail FROM (SELECT {a} AS a, {b} AS b)" for k, (a, b) in pairs.items())
    fin = f"SELECT user_id, segment_code, hv_state, is_abnormal, station_pref, time_pref, {_SLOTS} FROM final"
    out = "SELECT s.user_id, station_pref, time_pref, " + ", ".join(f"coalesce(nullif({x}, ''), {q(V.NONE)}) AS {x}" for x in ds + dh) + " FROM silent s LEFT JOIN details USING (user_id)"
    return full[: full.rindex("SELECT 1 FROM")].rstrip() + f",\nhist AS ({hist}),\nhranked AS ({ranked}),\ndetails AS ({select}),\nfin AS ({fin}),\nsilout AS ({out})\n{rows}"


QUERIES["segment_checks"], ORACLES["segment_checks"] = checks, _checks_oracle()
_RANKED = "SELECT user_id, n_orders, {c} AS sum_paid, {d} AS sum_kwh FROM features"
add("ranked_output", lambda s, d: O.rounded(P.ranked_output(P.user_features(P.valid_user_filter(O.base(s, d)))).select("user_id", "n_orders", "sum_paid", "sum_kwh")), _RANKED.format(c=rnd("sum_paid"), d=rnd("sum_kwh")) + " ORDER BY n_orders DESC, sum_paid DESC, sum_kwh DESC, user_id")
_old = lambda: F.when(F.col("hv_state") == V.EXITED, F.lit(next(iter(V.LEGACY_STATES)))).otherwise(F.col("hv_state"))
add("legacy_state_alias", lambda s, d: O.lists(s, d)["states"].select("user_id", G.legacy_state_alias(_old()).alias("hv_state")), "SELECT user_id, hv_state FROM states")
add("legacy_hv_classes", lambda s, d: (lambda x: G.legacy_hv_classes(x["states"], x["daily"].agg(F.max("order_date").alias("end_date"))))(O.lists(s, d)), f"SELECT user_id, hv_state, CASE WHEN hv_state = {q(V.STABLE)} AND hv_start >= (SELECT max(order_date) FROM daily) - 29 THEN '新晋高价值' WHEN hv_state = {q(V.STABLE)} THEN '稳定高价值' WHEN hv_state = {q(V.RETURNING)} THEN '回流高价值' WHEN hv_state = {q(V.EXITED)} AND hv_segments >= 2 THEN '回流后退出' WHEN hv_state = {q(V.EXITED)} THEN '阶段性高价值' ELSE '高价值流失' END AS legacy_class FROM states")
_TIER = "CASE WHEN days_since_last BETWEEN 8 AND 15 THEN 1 WHEN days_since_last BETWEEN 16 AND 30 THEN 2 WHEN days_since_last BETWEEN 31 AND 60 THEN 3 WHEN days_since_last BETWEEN 61 AND 90 THEN 4 WHEN days_since_last BETWEEN 91 AND 180 THEN 5 END"
# written from the document's tables: coupon by segment and tier, the override for coupon dependence, the order of sending
_COUPON = """
SELECT user_id, segment_code, tier, CASE WHEN dependent AND coupon IN ('满减券', '甲方券包') THEN '折扣券' ELSE coupon END AS coupon,
       CAST(CASE WHEN dependent THEN CASE amount WHEN 40 THEN 30 WHEN 30 THEN 20 WHEN 20 THEN 15 WHEN 15 THEN 10 WHEN 10 THEN 8 WHEN 8 THEN 5 WHEN 5 THEN 3 ELSE 2 + amount * 0 END ELSE amount END AS INT) AS amount,
       CAST(CASE WHEN coupon IS NULL THEN NULL WHEN segment_code IN ('05', '07') OR lost THEN CASE WHEN t >= 3 THEN 30 ELSE 15 END WHEN segment_code = '02' THEN 15 WHEN coupon = '甲方券包' THEN CASE WHEN segment_code = '10' OR t >= 3 THEN 30 WHEN t = 2 THEN 15 ELSE 7 END ELSE 7 END AS INT) AS days,
       valley_bound, compensation,
       CAST(CASE WHEN segment_code = '05' AND t IN (1, 2) THEN 1 WHEN segment_code IN ('03', '04') AND t = 1 THEN 2 WHEN segment_code = '05' AND t IN (3, 4) THEN 3 WHEN segment_code = '10' THEN 4
            WHEN segment_code IN ('06', '08') AND t = 1 THEN 5 WHEN segment_code = '11' AND t > 0 THEN 6 WHEN segment_code = '09' THEN 7 END AS INT) AS send_order
FROM (SELECT *, CASE WHEN segment_code IN ('05', '07', '04', '02') OR lost THEN '满减券' WHEN segment_code = '01' THEN '新手成长任务券' WHEN segment_code = '03' THEN '月度阶梯折扣' WHEN segment_code = '06' THEN '阶梯任务券' WHEN segment_code = '08' THEN '谷段时长折扣券'
                     WHEN segment_code = '09' THEN CASE WHEN t IN (3, 4) THEN '甲方券包' ELSE '阶梯任务券' END WHEN segment_code = '10' OR segment_code = '11' AND t > 0 THEN '甲方券包' END AS coupon,
             CASE WHEN segment_code IN ('05', '07', '04') OR lost THEN 15 WHEN segment_code IN ('01', '02', '06') THEN 5 WHEN segment_code = '03' THEN 8 WHEN segment_code = '08' THEN 2 WHEN segment_code = '10' THEN 40
                  WHEN segment_code = '09' THEN CASE t WHEN 3 THEN 20 WHEN 4 THEN 30 ELSE 3 END WHEN segment_code = '11' THEN CASE t WHEN 1 THEN 5 WHEN 2 THEN 10 WHEN 3 THEN 20 WHEN 4 THEN 30 WHEN 5 THEN 40 END END AS amount
      FROM (SELECT *, coalesce(tier, 0) AS t FROM (SELECT user_id, segment_code, {tier} AS tier, segment_code = '11' AND coalesce(hv_state, '') <> '' AS lost, coalesce(coupon_level = '高', false) AS dependent, valley_level = '高' AS valley_bound, is_abnormal AS compensation FROM final)))
"""
add("coupon_assignment", lambda s, d: G.coupon_assignment(O.final(s, d)[0]), _COUPON.format(tier=_TIER))
_NIGHT = "(CAST(substring(top_hour1, 1, 2) AS INT) >= 22 OR CAST(substring(top_hour1, 1, 2) AS INT) <= 7)"
add("targeting_form", lambda s, d: G.targeting_form(O.places(s, d)), f"SELECT user_id, CASE WHEN station_share1 >= 0.5 AND {_NIGHT} THEN '绑站谷段券' WHEN station_share1 >= 0.5 THEN '绑站通用券' WHEN {_NIGHT} THEN '通用谷段券' ELSE '通用券' END AS form FROM final")

# ---- sources and sinks: written below the shared folder and read back
def landing(s, d):
    return L.landing_scan(s, f"{d}/orders.parquet").groupBy("source_table").agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))


def csv_files(s, d):
    """Orders as CSV files of two headers, and a third of lines that fit neither."""
    path, rows = O.scratch(s, "csv"), projection(s, d, "charge_raw").select("order_id", "user_id", "station_id", "start_time", "end_time", "kwh", "channel")
    odd = F.col("order_id").cast("long") % 2 == 1
    L.export_csv(rows.where(~odd).drop("channel"), f"{path}/a")
    L.export_csv(rows.where(odd).select("kwh", "channel", "station_id", "order_id", "user_id"), f"{path}/b")
    lines = F.when(F.col("order_id").cast("long") % 100 == 7, F.concat("order_id", F.lit(",9"))).otherwise(F.concat("order_id", F.lit(",x,1,surplus")))
    lines = rows.where(F.col("order_id").cast("long") % 50 == 7).select(lines.alias("value"))
    lines.coalesce(1).withColumn("n", F.lit(1)).unionByName(s.createDataFrame([("order_id,station_id,kwh", 0)], "value string, n int")).repartition(1).sortWithinPartitions("n").select("value").write.text(f"{path}/c")
    return path


def csv_round_trip(s, d):
    return L.csv_tolerant_scan(s, csv_files(s, d)).groupBy("station_id").agg(F.count("*").alias("n"), F.count("user_id").alias("users"), F.count("channel").alias("channels"), F.count("start_time").alias("starts"), F.sum(F.col("kwh").try_cast("decimal(18,3)")).cast("double").alias("kwh"))


def csv_bad_lines(s, d):
    kind = F.regexp_extract("source_file", "/([abc])/[^/]*$", 1).alias("kind")
    return L.csv_bad_lines(s, csv_files(s, d)).groupBy(kind).agg(F.sum("lines").alias("lines"), F.sum("bad_lines").alias("bad_lines"))


def landed(s, d):
    """Orders as a folder of Parquet files for each month, the manifest of the months before May, recorded by an earlier run, and of
    one more that has changed since."""
    root, at = O.scratch(s, "landing"), O.scratch(s, "manifest")
    rows = sources(s, d)
    rows.hint("rebalance", "source_table").write.partitionBy("source_table").parquet(root)  # a month of many rows is several files
    listing = M.list_sources(s, root, "folder", "*.parquet")
    told = listing.join(M.facts(s, listing, "folder"), "source_table").where("source_table < 'y01_m05'")
    changed = F.when(F.col("source_table") == "y01_m04", 1).otherwise(0)
    M.record(told.withColumns({"n_rows": F.col("n_rows") - changed, "length": F.col("length") - changed}), at, 1)
    return root, at, rows.drop("source_table").schema


def incremental(s, d):
    root, at, schema = landed(s, d)
    fresh = M.new_sources(M.list_sources(s, root, "folder", "*.parquet"), M.read_manifest(s, at))
    return M.read_sources(s, fresh, schema, by="folder").groupBy("source_table").agg(F.count("*").alias("n_rows"))


def imported(s, d):
    """Rows of new and changed sources, then a second run that finds nothing left to do."""
    root, at, schema = landed(s, d)
    rows, told = M.import_new(s, root, at, schema, 2, "folder")
    out = O.written(rows.groupBy("source_table").agg(F.count("*").alias("n_rows")), "imported")
    M.record(told, at, 2)
    again = M.import_new(s, root, at, schema, 3, "folder")[0].groupBy("source_table").agg(F.count("*").alias("again"))
    return out.join(again, "source_table", "left").na.fill(0, ["again"])


def sink_replace(s, d):
    """Months appended, the first six written again in their place."""
    path = O.scratch(s, "sink")
    rows = O.day(s, d).select("order_id", F.month("start_ts").alias("month"), F.lit(0).alias("again"))
    L.sink(rows, path, "append", ("month",))
    L.sink(rows.where("month <= 6").withColumn("again", F.lit(1)), path, "overwrite", ("month",))
    return L.read_merged(s, path).groupBy("month").agg(F.count("*").alias("n"), F.sum("again").alias("again"))


def fed(s, d, rows, feed):
    """Three runs of a feed over one checkpoint, each after a third of the rows has landed; the folder of its tables."""
    src, out, ckpt = (O.scratch(s, f"feed-{k}") for k in ("in", "out", "checkpoint"))
    for n in range(3):
        rows.where(F.col("order_id").cast("long") % 3 == n).write.parquet(f"{src}/{n}")
        feed(streams.order_stream(s, f"{src}/*", rows.schema), out, ckpt).awaitTermination()
    return out


def session_feed(s, d):
    out = fed(s, d, projection(s, d, "charge_raw"), lambda r, o, c: feeds.session_feed(r, o, c, buckets=16))
    return s.read.parquet(f"{out}/sessions").select(*_SESS)


def hourly_late(s, d):
    out = fed(s, d, O.day(s, d), lambda r, o, c: feeds.hourly_feed(r, o, c, "100 DAYS", "month"))
    return feeds.late_rows(s, out).select("batch", "rows", "late")


def hourly_orders(s, d):
    out = fed(s, d, O.day(s, d), lambda r, o, c: feeds.hourly_feed(r, o, c, "100 DAYS", "month"))
    return s.read.parquet(f"{out}/sums").select("hour", "orders")


_BATCH = "SELECT CAST(order_id AS BIGINT) % 3 AS batch, start_ts, date_trunc('hour', start_ts) AS hour FROM charge_day"
_LATE = f"SELECT b.*, hour + INTERVAL 1 HOUR <= mark AS late FROM ({_BATCH}) b LEFT JOIN (SELECT a.batch, max(e.start_ts) - INTERVAL 100 DAY AS mark FROM (SELECT DISTINCT batch FROM ({_BATCH})) a JOIN ({_BATCH}) e ON e.batch < a.batch GROUP BY 1) USING (batch)"
add("session_feed", session_feed, f"SELECT {', '.join(_SESS)} FROM sessions1")
add("user_day_feed", lambda s, d: feeds.user_days(s, fed(s, d, O.day(s, d), lambda r, o, c: feeds.user_day_feed(r, o, c, span="month"))).withColumn("kwh", F.col("kwh").cast("double")), "SELECT user_id, order_date, orders, CAST(kwh AS DOUBLE) AS kwh, last_ts FROM daily")
add("hourly_feed", hourly_orders, f"SELECT hour, count(*) AS orders FROM ({_LATE}) WHERE NOT coalesce(late, false) GROUP BY 1")
add("late_rows", hourly_late, f"SELECT CAST(batch AS INT) AS batch, count(*) AS rows, count(*) FILTER (late) AS late FROM ({_LATE}) GROUP BY 1")
add("landing_scan", landing, "SELECT 'orders' AS source_table, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders")
add("csv_tolerant_scan", csv_round_trip, "SELECT station_id, count(*) AS n, count(nullif(user_id, '')) AS users, count(channel) FILTER (CAST(order_id AS BIGINT) % 2 = 1) AS channels, count(start_time) FILTER (CAST(order_id AS BIGINT) % 2 = 0) AS starts, CAST(sum(TRY_CAST(kwh AS DECIMAL(18,3))) AS DOUBLE) AS kwh FROM charge_raw GROUP BY 1")
add("csv_bad_lines", csv_bad_lines, "SELECT kind, count(*) AS lines, count(*) FILTER (kind = 'c') AS bad_lines FROM (SELECT CASE WHEN CAST(order_id AS BIGINT) % 2 = 1 THEN 'b' ELSE 'a' END AS kind FROM charge_raw UNION ALL SELECT 'c' FROM charge_raw WHERE CAST(order_id AS BIGINT) % 50 = 7) GROUP BY 1")
add("incremental_sources", incremental, "SELECT source_table, count(*) AS n_rows FROM (SELECT 'y' || strftime(start_ts, '%y_m%m') AS source_table FROM charge_day) WHERE source_table NOT IN ('y01_m01', 'y01_m02', 'y01_m03', 'y01_m04') GROUP BY 1")
add("import_manifest", imported, "SELECT source_table, count(*) AS n_rows, CAST(0 AS BIGINT) AS again FROM (SELECT 'y' || strftime(start_ts, '%y_m%m') AS source_table FROM charge_day) WHERE source_table NOT IN ('y01_m01', 'y01_m02', 'y01_m03') GROUP BY 1")
add("sink_replace_or_append", sink_replace, "SELECT month(start_ts) AS month, count(*) AS n, sum(CASE WHEN month(start_ts) <= 6 THEN 1 ELSE 0 END) AS again FROM charge_day GROUP BY 1")
add(
    "share_rounding",
    lambda s, d: R.share_rounding(O.valid(s, d).groupBy("station_category", "short_period").agg(F.count("*").alias("n")), ["station_category"]).select("station_category", "short_period", "percent"),
    "SELECT station_category, short_period, CAST(p + CASE WHEN row_number() OVER (PARTITION BY station_category ORDER BY n DESC, short_period) = 1 THEN 100 - sum(p) OVER (PARTITION BY station_category) ELSE 0 END AS DOUBLE) AS percent FROM (SELECT station_category, short_period, n, round(CAST(n * 100.0 / sum(n) OVER (PARTITION BY station_category) AS DECIMAL(20,8)), 1) AS p FROM (SELECT station_category, short_period, count(*) AS n FROM rep GROUP BY 1, 2))",
)

# ---- reports
add("daily_trend", lambda s, d: R.trend(O.valid(s, d), "day"), "SELECT CAST(start_ts AS DATE) AS period, year, count(*) AS orders FROM rep GROUP BY GROUPING SETS ((1, 2), (1))".replace("((1, 2), (1))", "((CAST(start_ts AS DATE), year), (CAST(start_ts AS DATE)))"))
add("monthly_trend", lambda s, d: R.trend(O.valid(s, d), "month"), "SELECT p AS period, year, count(*) AS orders FROM (SELECT CAST(date_trunc('month', start_ts) AS DATE) AS p, year FROM rep) GROUP BY GROUPING SETS ((p, year), (p))")
grid = lambda **v: " CROSS JOIN ".join(f"(SELECT unnest([{', '.join(map(q, x))}]) AS {k})" for k, x in v.items())
names = lambda table: [b for _, b in table]
hist = lambda c, items, e=None: f"SELECT {c}, coalesce(n, 0) AS n FROM {grid(**{c: items})} LEFT JOIN (SELECT {e or c} AS {c}, count(*) AS n FROM rep GROUP BY 1) USING ({c})"
tab = lambda a, x, b, y, s="rep": f"SELECT {a}, {b}, coalesce(n, 0) AS n FROM {grid(**{a: x, b: y})} LEFT JOIN (SELECT {a}, {b}, count(*) AS n FROM {s} GROUP BY ALL) USING ({a}, {b})"
add("category_distribution_orders", lambda s, d: R.histogram(O.valid(s, d), F.col("station_category"), V.CATEGORIES, "station_category"), hist("station_category", V.CATEGORIES))
_B13 = ["0min", *names(V.DURATION_13), V.DURATION_OVER]
add("duration_hist", lambda s, d: R.histogram(O.valid(s, d), S.duration_bucket_13(F.col("duration_min")), _B13, "bucket"), hist("bucket", _B13, Q.duration13("duration_min")))
add("hour_hist", lambda s, d: R.hour_hist(O.valid(s, d)), hist("hour", range(24), "hour(start_ts)"))
add("weekday_hour_matrix", lambda s, d: R.crosstab(O.valid(s, d), "weekday", "start_hour", V.WEEKDAYS, range(24)), tab("weekday", V.WEEKDAYS, "start_hour", range(24)))
add("duration_core_structure", lambda s, d: R.histogram(O.valid(s, d), F.col("duration_core"), names(V.DURATION_CORE), "duration_core"), hist("duration_core", names(V.DURATION_CORE)))
_WK = ("工作日", "周末")
add("weekday_weekend_duration", lambda s, d: R.crosstab(O.valid(s, d).withColumn("kind", F.when(S.is_weekend(F.col("start_ts")), _WK[1]).otherwise(_WK[0])), "kind", "duration_core", _WK, names(V.DURATION_CORE)), tab("kind", _WK, "duration_core", names(V.DURATION_CORE), f"(SELECT *, CASE WHEN isodow(start_ts) >= 6 THEN {q(_WK[1])} ELSE {q(_WK[0])} END AS kind FROM rep)"))
add("period_duration_matrix", lambda s, d: R.crosstab(O.valid(s, d), "short_period", "duration_detail", V.SHORT_PERIODS, names(V.DURATION_DETAIL)), tab("short_period", V.SHORT_PERIODS, "duration_detail", names(V.DURATION_DETAIL)))
add("period_share", lambda s, d: R.share_rounding(R.histogram(O.valid(s, d), F.col("short_period"), V.SHORT_PERIODS, "short_period"), []).select("short_period", "percent"), "SELECT short_period, CAST(p + CASE WHEN row_number() OVER (ORDER BY n DESC, short_period) = 1 THEN 100 - sum(p) OVER () ELSE 0 END AS DOUBLE) AS percent FROM (SELECT short_period, n, round(CAST(n * 100.0 / sum(n) OVER () AS DECIMAL(20,8)), 1) AS p FROM (SELECT short_period, count(*) AS n FROM rep GROUP BY 1))")
add("monthly_duration_trend", lambda s, d: R.monthly_quantiles(O.valid(s, d)), f"SELECT strftime(start_ts, '%Y-%m') AS month, {rnd('quantile_cont(duration_min, 0.5)')} AS median_min, {rnd('quantile_cont(duration_min, 0.75)')} AS p75_min FROM rep GROUP BY 1")
add("category_duration_energy", lambda s, d: R.category_duration_energy(O.valid(s, d)), f"SELECT station_category, count(*) AS orders, {rnd('median(duration_min)')} AS median_min, {rnd('avg(CAST(energy_kwh AS DECIMAL(18,3)))')} AS avg_kwh FROM rep GROUP BY 1")
_TOT = lambda c: f"(SELECT station_category, {c} FROM rep UNION ALL SELECT {q(V.TOTAL)}, {c} FROM rep)"
for _c, _items in (("short_period", V.SHORT_PERIODS), ("duration_core", names(V.DURATION_CORE)), ("energy_type", V.ENERGY_TYPES)):
    _n = {"short_period": "category_period", "duration_core": "category_duration", "energy_type": "category_energy_type"}[_c]
    add(_n, lambda s, d, c=_c, items=_items: R.crosstab(O.valid(s, d).select("station_category", c).unionByName(O.valid(s, d).select(F.lit(V.TOTAL).alias("station_category"), c)), "station_category", c, (V.TOTAL, *V.CATEGORIES), items), tab("station_category", (V.TOTAL, *V.CATEGORIES), _c, _items, _TOT(_c)))
add("with_total_row", lambda s, d: R.with_total_row(O.valid(s, d), "channel", F.count("*").alias("orders")), f"SELECT coalesce(channel, {q(V.TOTAL)}) AS channel, count(*) AS orders FROM rep GROUP BY ROLLUP (channel)")
add("crosstab", lambda s, d: R.crosstab_wide(O.valid(s, d), "channel", "charge_method", ["1-URGENT", "2-HIGH", "3-MEDIUM"], ["App", "刷卡"]), "SELECT channel, count(*) FILTER (charge_method = 'App') AS \"App\", count(*) FILTER (charge_method = '刷卡') AS \"刷卡\" FROM rep WHERE channel IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1")
add("category_reuse_rate", lambda s, d: R.category_reuse_rate(O.valid(s, d)), f"SELECT coalesce(station_category, {q(V.TOTAL)}) AS station_category, count(*) AS orders, {rnd(f'avg(CASE WHEN reuse_station = {q(V.YES)} THEN 1.0 ELSE 0.0 END)', 6)} AS reuse_rate FROM rep WHERE reuse_station IN ({q(V.YES)}, {q(V.NO)}) GROUP BY ROLLUP (station_category)")
add("category_discount_valley", lambda s, d: R.category_discount_valley(O.valid(s, d)), f"SELECT coalesce(station_category, {q(V.TOTAL)}) AS station_category, count(*) AS orders, {rnd('avg(CASE WHEN discount_amount > 0 THEN 1.0 ELSE 0.0 END)', 6)} AS coupon_rate, {rnd('avg(CASE WHEN valley_share >= 0.25 THEN 1.0 ELSE 0.0 END)', 6)} AS valley_rate FROM rep GROUP BY ROLLUP (station_category)")
add("duration_energy_matrix", lambda s, d: R.crosstab(O.valid(s, d).withColumn("energy_group", S.right_closed(F.col("energy_kwh"), V.ENERGY_MATRIX)), "duration_core", "energy_group", names(V.DURATION_CORE), names(V.ENERGY_MATRIX)), tab("duration_core", names(V.DURATION_CORE), "energy_group", names(V.ENERGY_MATRIX), f"(SELECT *, {Q.group('energy_kwh', V.ENERGY_MATRIX)} AS energy_group FROM rep)"))
add("channel_top10_other", lambda s, d: R.top_plus_other(O.valid(s, d), "station_id", 10), f"SELECT CASE WHEN r <= 10 THEN station_id ELSE {q(V.OTHER)} END AS value, CAST(sum(n) AS BIGINT) AS orders FROM (SELECT station_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, station_id) AS r FROM rep GROUP BY 1) GROUP BY 1")
_VB = ((0, "0"), (0.25, "0-25%"), (0.5, "25-50%"), (0.75, "50-75%"), (None, "75-100%"))
add("valley_ratio_hist", lambda s, d: R.histogram(O.valid(s, d), S.right_closed(F.col("valley_share"), _VB), names(_VB), "bucket"), hist("bucket", names(_VB), Q.group("valley_share", _VB)))
add("histogram_left_closed", lambda s, d: R.histogram(O.valid(s, d), R.left_closed(F.col("duration_min"), [0, 60, 120, 180, 240, 300]), range(5), "bin"), hist("bin", range(5), "CASE WHEN duration_min < 60 THEN 0 WHEN duration_min < 120 THEN 1 WHEN duration_min < 180 THEN 2 WHEN duration_min < 240 THEN 3 WHEN duration_min <= 300 THEN 4 END"))
add("valley_density", lambda s, d: R.valley_density(O.valid(s, d)), f"SELECT station_category, CAST(least(floor(valley_share * 50), 49) AS INT) AS bin, count(*) AS n, {rnd('count(*) * 50 / CAST(sum(count(*)) OVER (PARTITION BY station_category) AS DOUBLE)', 6)} AS density FROM rep GROUP BY 1, 2")
add("valley_density_total", lambda s, d: R.valley_density(O.valid(s, d), total=True), f"SELECT CASE WHEN g > 0 THEN {q(V.TOTAL)} ELSE station_category END AS station_category, bin, n, {rnd('n * 50 / CAST(sum(n) OVER (PARTITION BY g, station_category) AS DOUBLE)', 6)} AS density FROM (SELECT station_category, bin, count(*) AS n, grouping(station_category) AS g FROM (SELECT station_category, CAST(least(floor(valley_share * 50), 49) AS INT) AS bin FROM rep WHERE valley_share BETWEEN 0 AND 1) GROUP BY GROUPING SETS ((station_category, bin), (bin)))")
add("valley_kde", lambda s, d: R.valley_kde(O.valid(s, d)), f"SELECT x, {rnd('sum(exp(-power((x - v) / 0.05, 2) / 2) * n) / sum(n) / (0.05 * sqrt(2 * pi()))')} AS density FROM (SELECT round(valley_share, 2) AS v, count(*) AS n FROM rep GROUP BY 1) CROSS JOIN (SELECT unnest(range(21)) / 20.0 AS x) GROUP BY x")
_DRAW = "CAST('0x' || substr(md5(order_id || ':42'), 1, 15) AS BIGINT)"
add("bounded_random_sample", lambda s, d: R.bounded_random_sample(O.valid(s, d), "station_category", "order_id", 1000).select("station_category", "order_id"), f"SELECT station_category, order_id FROM rep QUALIFY row_number() OVER (PARTITION BY station_category ORDER BY {_DRAW}, order_id) <= 1000")
add("category_order_station_totals", lambda s, d: C.category_share(O.valid(s, d)).select("category", "orders", "stations"), f"SELECT category, coalesce(n, 0) AS orders, coalesce(st, 0) AS stations FROM {_CATS} LEFT JOIN (SELECT station_category AS category, count(*) AS n, count(DISTINCT station_id) AS st FROM rep GROUP BY 1) USING (category)")
add("drop_cross_year", lambda s, d: R.drop_cross_year(O.day(s, d).withColumn("source_table", F.when(F.minute("start_ts") % 2 == 0, F.lit("y01_a")).otherwise(F.lit("x_2002"))).select("order_id", "start_ts", "source_table")).select("order_id"), "SELECT order_id FROM charge_day WHERE minute(start_ts) % 2 = 0")
add("min_group_size", lambda s, d: R.min_group_size(O.day(s, d), F.month("start_ts"), 100).groupBy(F.month("start_ts").alias("month")).agg(F.count("*").alias("orders")), "SELECT month(start_ts) AS month, count(*) AS orders FROM charge_day GROUP BY 1 HAVING count(*) >= 100")
add("analysis_summary", lambda s, d: R.analysis_summary(O.valid(s, d)), unpivot({"categories": "count(DISTINCT station_category)", "days": "count(DISTINCT CAST(start_ts AS DATE))", "months": "count(DISTINCT strftime(start_ts, '%Y-%m'))"}, "rep"))
add("monthly_tier_discount", lambda s, d: R.monthly_tier_discount(O.day(s, d)), "SELECT *, CASE WHEN kwh <= 50 THEN 99 WHEN kwh <= 100 THEN 95 WHEN kwh <= 200 THEN 90 WHEN kwh <= 300 THEN 85 ELSE 80 END AS pay_percent FROM (SELECT user_id, strftime(start_ts, '%Y-%m') AS month, CAST(sum(CAST(energy_kwh AS DECIMAL(18,3))) AS DOUBLE) AS kwh FROM charge_day GROUP BY ALL)")
_CURVE = f"SELECT scope, v, count(*) AS c FROM (SELECT {q(V.ALL_STATIONS)} AS scope, CAST(round(valley_share, 3) AS DECIMAL(4,3)) AS v FROM rep WHERE valley_share BETWEEN 0 AND 1 UNION ALL SELECT station_category, CAST(round(valley_share, 3) AS DECIMAL(4,3)) FROM rep WHERE valley_share BETWEEN 0 AND 1 AND station_category IN ({', '.join(map(q, V.CURVES))})) GROUP BY ALL"
_SHAPE = f"SELECT scope, CAST(sum(c) AS DOUBLE) AS n, 1.1 * power(sum(c), -0.2) * sqrt((CAST(sum(c * v * v) AS DOUBLE) - power(CAST(sum(c * v) AS DOUBLE), 2) / sum(c)) / (sum(c) - 1)) AS bw FROM ({_CURVE}) GROUP BY scope"
add("valley_curves", lambda s, d: R.valley_curves(O.valid(s, d)), f"SELECT scope, x, {rnd('sum(c * exp(-power((x - v) / bw, 2) / 2) / (n * bw * sqrt(2 * pi())))')} AS density, {rnd('any_value(bw)', 6)} AS bandwidth, CAST(any_value(n) AS BIGINT) AS orders FROM (SELECT scope, CAST(v AS DOUBLE) AS v, c FROM ({_CURVE})) JOIN ({_SHAPE}) USING (scope) CROSS JOIN (SELECT unnest(range(101)) / 100.0 AS x) GROUP BY scope, x")
add("yearly_structure", lambda s, d: R.yearly_structure(O.valid(s, d)), f"SELECT year, field, value, count(*) AS orders, {rnd('count(*) / CAST(sum(count(*)) OVER (PARTITION BY year, field) AS DOUBLE)', 6)} AS share FROM (SELECT year, 'period' AS field, short_period AS value FROM rep UNION ALL SELECT year, 'channel', channel FROM rep) GROUP BY year, field, value")
add("yearly_trends", lambda s, d: R.yearly_trends(O.valid(s, d)), f"SELECT year, count(*) AS orders, {rnd('CAST(sum(CAST(energy_kwh AS DECIMAL(18,3))) AS DOUBLE) / count(energy_kwh)')} AS avg_kwh, {rnd('avg(CASE WHEN discount_amount > 0 THEN 1.0 ELSE 0.0 END)', 6)} AS coupon_rate, count(*) FILTER (reuse_station IN ({q(V.YES)}, {q(V.NO)})) AS with_station_before, {rnd(f'avg(CASE reuse_station WHEN {q(V.YES)} THEN 1.0 WHEN {q(V.NO)} THEN 0.0 END)', 6)} AS reuse_rate FROM rep GROUP BY 1")
add("yearly_top_reasons", lambda s, d: R.yearly_top_reasons(C.abnormal_orders(O.main(s, d)), 3), f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY orders DESC, reason) AS rank FROM (SELECT year(start_ts) AS year, coalesce(nullif(trim(end_reason), ''), {q(V.UNKNOWN)}) AS reason, count(*) AS orders FROM main WHERE end_reason_class IN ({q(V.END_FAULT)}, {q(V.END_OTHER)}) GROUP BY ALL)) WHERE rank <= 3")
add("yearly_behaviour", lambda s, d: R.yearly_behaviour(O.valid(s, d)), "SELECT year, count(*) AS orders, " + ", ".join(f"{rnd(f'avg(CASE WHEN short_period = {q(p)} THEN 1.0 ELSE 0.0 END)', 6)} AS share_{k}" for k, p in enumerate(V.SHORT_PERIODS)) + f", {rnd('avg(CASE WHEN discount_amount > 0 THEN 1.0 ELSE 0.0 END)', 6)} AS coupon_rate, count(*) FILTER (end_reason_class = {q(V.END_FAULT)}) AS fault_orders FROM rep GROUP BY 1")
add("user_frequency_summary", lambda s, d: R.user_frequency_summary(O.day(s, d), 50), f"SELECT year, count(*) AS users, max(n) AS most, min(n) AS least, {rnd('avg(CASE WHEN n >= 50 THEN 1.0 ELSE 0.0 END)', 6)} AS share_many, {rnd('avg(CASE WHEN n = 1 THEN 1.0 ELSE 0.0 END)', 6)} AS share_once FROM (SELECT year(start_ts) AS year, user_id, count(*) AS n FROM charge_day GROUP BY ALL) GROUP BY 1")
