"""SQL building blocks of the oracles: named common table expressions over the driver's tables."""

from __future__ import annotations

import re

from .. import values as V
from ..sources import fixtures


def q(x) -> str:
    return "NULL" if x is None else "'" + str(x).replace("'", "''") + "'" if isinstance(x, str) else str(x)


def ins(items) -> str:
    return "(" + ", ".join(q(x) for x in items) + ")"


def case(pairs, default) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {default} END"


def rnd(x: str, n: int = 4) -> str:
    """Half-up rounding on the decimal text of a double."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def nt(x: str) -> str:
    t = f"regexp_replace(trim({x}), '^([0-9]+)\\.0$', '\\1')"
    return f"CASE WHEN {x} IS NULL OR {t} IN {ins(V.NULL_TEXTS)} THEN NULL ELSE {t} END"


def station_key(x: str) -> str:
    return f"nullif(trim(regexp_replace({nt(x)}, '^(?i:station-)', '')), '')"


def category(x: str) -> str:
    t = f"regexp_replace(replace(replace({nt(x)}, '（', '('), '）', ')'), '\\s+', '', 'g')"
    return case([(f"{t} IN {ins(names)}", q(c)) for c, names in V.STATION_TYPES.items()], q(V.OTHER))


def any_of(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(w)})" for w in words) + ")"


def end_class(x: str) -> str:
    t = f"coalesce({nt(x)}, {q(V.UNKNOWN)})"
    return case([*((any_of(t, w), q(n)) for n, w in V.END_WORDS), (any_of(f"upper({t})", V.END_CODES), q(V.END_FAULT))], q(V.END_OTHER))


def band(h: str, labels) -> str:
    return case([(f"{h} IS NULL", q(V.UNKNOWN)), (f"{h} <= 5", q(labels[0])), (f"{h} <= 11", q(labels[1])), (f"{h} <= 17", q(labels[2]))], q(labels[3]))


def hour_label(ts: str) -> str:
    h = f"lpad(CAST(hour({ts}) AS VARCHAR), 2, '0')"
    return f"CASE WHEN {ts} IS NULL THEN {q(V.UNKNOWN)} ELSE {h} || ':00-' || {h} || ':59' END"


def weekday(ts: str) -> str:
    return case([(f"isodow({ts}) = {k}", q(d)) for k, d in enumerate(V.WEEKDAYS, 1)], q(V.UNKNOWN))


def bins(x: str, table, first: list = ()) -> str:
    return case([*first, *((f"{x} <= {a}", q(b)) for a, b in table if a is not None)], q(table[-1][1]))


def duration13(x: str) -> str:
    return case([(f"{x} IS NULL", q(V.UNKNOWN)), (f"{x} < 0", q("时间异常")), (f"{x} = 0", q("0min")), *((f"{x} <= {a}", q(b)) for a, b in V.DURATION_13)], q(V.DURATION_OVER))


def energy(x: str) -> str:
    return bins(x, V.ENERGY, [(f"{x} IS NULL", q(V.UNKNOWN)), (f"{x} = 0", q("0kWh"))])


def gap(x: str) -> str:
    return bins(x, V.GAPS, [(f"{x} IS NULL", q(V.FIRST))])


def group(x: str, table) -> str:
    return bins(x, table, [(f"{x} IS NULL OR {x} < 0", "NULL")])


def secs(a: str, b: str) -> str:
    return f"(epoch({b}) - epoch({a}))"


def rfm(r: str, f: str, m: str) -> str:
    return case([(f"{r} <= 2 AND {f} <= 2 AND {m} >= 4", q(V.HV_ACTIVE)), (f"{r} >= 4 AND {f} <= 2 AND {m} >= 4", q(V.HV_RISK)), (f"{r} <= 2 AND {f} >= 4", q(V.NEW_LOW)), (f"{f} <= 2 AND {m} < 3", q(V.HIGH_LOW)), (f"{f} >= 4 AND {m} <= 2", q(V.LOW_LOW))], q(V.GENERAL))


def r_score(x: str) -> str:
    return f"CASE WHEN {x} <= 7 THEN 1 WHEN {x} <= 14 THEN 2 WHEN {x} <= 30 THEN 3 WHEN {x} <= 60 THEN 4 ELSE 5 END"


def f_score(x: str) -> str:
    return f"CASE WHEN {x} <= 4 THEN 1 WHEN {x} <= 7 THEN 2 WHEN {x} <= 14 THEN 3 WHEN {x} <= 20 THEN 4 ELSE 5 END"


def m_score(x: str) -> str:
    return f"CASE WHEN {x} >= 40 THEN 5 WHEN {x} >= 30 THEN 4 WHEN {x} >= 20 THEN 3 WHEN {x} >= 10 THEN 2 ELSE 1 END"


def pick(score: str, names) -> str:
    return case([(f"{score} = {k}", q(n)) for k, n in enumerate(names, 1)], "NULL")


def tou(segment: str, day: str, a: str, b: str) -> str:
    part = lambda t: " + ".join(f"greatest(0, least(epoch({b}), epoch({day}) + {h1 * 3600}) - greatest(epoch({a}), epoch({day}) + {h0 * 3600}))" for h0, h1 in V.TARIFFS[t][segment])
    return f"(CASE WHEN {day} < TIMESTAMP '{V.TARIFF_CHANGE}' THEN {part('legacy')} WHEN month({day}) IN {ins(V.SEASON_MONTHS)} THEN {part('summer_winter')} ELSE {part('other')} END)"


_N = lambda c: f"coalesce({c}, 0.0)"
_RULES = (
    "status IN ('废弃', '已取消')", "k0 > 800", "m0 > 800", "e0 > 500", "s0 > 500", "e0 + s0 > 800", "k0 < 0", "k0 <> 0 AND e0 / k0 > 4", "m0 < 0", "secs < 0", "k0 < 0.1 AND s0 + e0 <> 0", "secs > 0 AND k0 < 0.1",
    "abs(k0 - m0) > 0.1", "abs(f0 - k0) > 0.1", "secs > 64800", "start_ts IS NULL OR end_ts IS NULL", f"start_ts < TIMESTAMP '{V.CleanRules().earliest}' OR start_ts > TIMESTAMP '{V.CleanRules().cutoff}'",
)
_SEQ = f"""
SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_ts, order_id) AS user_seq,
       row_number() OVER (PARTITION BY user_id, month(start_ts) ORDER BY start_ts, order_id) AS user_month_seq,
       {rnd('CAST(epoch(start_ts) - epoch(lag(start_ts) OVER (PARTITION BY user_id ORDER BY start_ts, order_id)) AS DOUBLE) / 3600', 3)} AS gap_h,
       lag(station_id) OVER (PARTITION BY user_id ORDER BY start_ts, order_id) AS prev_station
FROM %s"""
_REUSE = f"CASE WHEN user_seq = 1 THEN '首次充电' WHEN station_id IS NULL OR prev_station IS NULL THEN '站点缺失' WHEN station_id = prev_station THEN {q(V.YES)} ELSE {q(V.NO)} END AS reuse_station"
_NEXT = "date_trunc('day', start_ts) + INTERVAL 1 DAY"
_END0 = f"least(end_ts, {_NEXT})"
_START1 = f"greatest(start_ts, {_NEXT})"


def _split(segment: str) -> str:
    d = f"({tou(segment, 'd0', 'start_ts', 'e0_ts')} + {tou(segment, 'd1', 's1_ts', 'end_ts')})"
    return f"CASE WHEN secs > 0 THEN {rnd(f'coalesce(energy_kwh, 0) * {d} / secs', 3)} ELSE 0.0 END AS {segment}_kwh"


_FLAGS = {
    "is_small_hours": "hour(start_ts) <= 5", "is_weekend": "isodow(start_ts) >= 6", "is_night": "hour(start_ts) >= 18 OR hour(start_ts) <= 5", "is_cross_day": "CAST(start_ts AS DATE) <> CAST(end_ts AS DATE)", "is_short": "duration_min <= 30", "is_long": "duration_min > 240",
    "is_high_energy": "energy_kwh >= 40", "used_discount": "discount_amount > 0", "valley_order": "valley_share >= 0.5", "reused_station": f"reuse_station = {q(V.YES)}", "is_risk": f"valid AND (abnormal_reason NOT IN ('', {q(V.NONE)}, 'None', 'null') OR end_reason_class = {q(V.END_FAULT)})",
    "is_fault_end": f"end_reason_class = {q(V.END_FAULT)}", "is_zero": "energy_kwh <= 0", "is_overlong": "duration_min > 240",
}
_LEFT = "ranked WHERE attribute = "


def _conc(a: str, names) -> str:
    n = lambda k, c: f"max(CASE WHEN rn = {k} THEN {c} END)"
    s = lambda k: f"(coalesce({n(k, 'n')}, 0) / CAST(max(total) AS DOUBLE))"
    cols = ", ".join(f"{n(k, 'value')} AS {x}" for k, x in enumerate(names, 1))
    return (
        f"SELECT user_id, {cols}, {s(1)} AS {a}_share1, {s(2)} AS {a}_share2, {s(3)} AS {a}_share3, {s(1)} + {s(2)} AS {a}_top2, {s(1)} + {s(2)} + {s(3)} AS {a}_top3, "
        f"least({s(1)}, {s(2)}) AS {a}_min2, least({s(1)}, {s(2)}, {s(3)}) AS {a}_min3, max(kinds) AS n_{a}s FROM ranked WHERE attribute = '{a}' GROUP BY user_id"
    )


def _rank(source: str, columns: dict[str, str]) -> str:
    pairs = " UNION ALL ".join(f"SELECT user_id, '{k}' AS attribute, trim({c}) AS value FROM {source}" for k, c in columns.items())
    return f"""SELECT *, sum(n) OVER (PARTITION BY user_id, attribute) AS total, count(*) OVER (PARTITION BY user_id, attribute) AS kinds,
       row_number() OVER (PARTITION BY user_id, attribute ORDER BY n DESC, value) AS rn
FROM (SELECT user_id, attribute, value, count(*) AS n FROM ({pairs}) WHERE value IS NOT NULL AND value NOT IN ('', {q(V.UNKNOWN)}) GROUP BY ALL)"""


def station_pref(n="n_orders", p="station_") -> str:
    return case([(f"{n} <= 5", q(V.TOO_FEW)), (f"{p}share1 >= 0.5", q("固定站点用户")), (f"{p}top2 >= 0.6 AND {p}min2 >= 0.2", q("双站点用户")), (f"{p}top3 >= 0.7 AND {p}min3 >= 0.1", q("三站点用户")), ("n_stations >= 5", q("多站流动用户"))], q("一般站点用户"))


def time_pref(n="n_orders", p="hour_") -> str:
    return case([(f"{n} <= 5", q(V.TOO_FEW)), (f"{p}share1 >= 0.5", q("单时段偏好")), (f"{p}top2 >= 0.6 AND {p}share2 >= 0.15", q("双时段偏好")), (f"{p}top3 >= 0.7 AND {p}share3 >= 0.1", q("三时段偏好")), (f"{p}share1 >= 0.3", q("轻度时段偏好"))], q("无明显偏好"))


_DEC = lambda c: f"CAST(sum(CAST({c} AS DECIMAL(18,3))) AS DOUBLE)"
_MIN = lambda: "CAST(round(CAST((epoch(end_ts) - epoch(start_ts)) / 60.0 AS DECIMAL(38,12)), 3) AS DOUBLE)"
_HV = q(V.HV_ACTIVE)
_NB = f"coalesce(trim(station_category), '') <> {q(V.BUS)}"

BLOCKS = {
    "charge_day": fixtures.CHARGE_DAY,
    "charge_raw": fixtures.CHARGE_RAW,
    "station": fixtures.STATION,
    "bridge": fixtures.BRIDGE,
    "asset": fixtures.ASSET,
    "mapping": fixtures.MAPPING,
    "assets": f"SELECT *, CASE WHEN status = {q(V.RETIRED)} THEN 'retired' WHEN station_key IS NULL THEN 'no key' WHEN station_type IS NULL THEN 'no type' WHEN (lon IS NOT NULL AND longitude IS NULL) OR (lat IS NOT NULL AND latitude IS NULL) THEN 'bad place' ELSE 'kept' END AS outcome FROM (SELECT *, CASE WHEN abs(TRY_CAST(lon AS DOUBLE)) <= 180 THEN TRY_CAST(lon AS DOUBLE) END AS longitude, CASE WHEN abs(TRY_CAST(lat AS DOUBLE)) <= 90 THEN TRY_CAST(lat AS DOUBLE) END AS latitude, year(since) AS since_year, strftime(since, '%Y-%m') AS since_month FROM (SELECT {station_key('station_id')} AS station_key, replace(replace(station_type, '（', '('), '）', ')') AS station_type, {category('station_type')} AS category, place, coalesce(nullif(trim(status), ''), {q(V.UNKNOWN)}) AS status, nullif(trim(longitude), '') AS lon, nullif(trim(latitude), '') AS lat, TRY_CAST(trim(since) AS DATE) AS since FROM asset))",
    "typed": f"SELECT order_id, {nt('user_id')} AS user_id, {station_key('station_id')} AS station_id, status, TRY_CAST(start_time AS TIMESTAMP) AS start_ts, TRY_CAST(end_time AS TIMESTAMP) AS end_ts, CAST(kwh AS DOUBLE) AS kwh, CAST(meter_kwh AS DOUBLE) AS meter_kwh, CAST(ef AS DOUBLE) AS ef, CAST(sf AS DOUBLE) AS sf, CAST(flat_kwh AS DOUBLE) AS raw_flat, end_reason, channel FROM charge_raw",
    "judged": f"SELECT *, {case([(r, k) for k, r in enumerate(_RULES, 1)], 0)} AS discard_code FROM (SELECT *, {_N('kwh')} AS k0, {_N('meter_kwh')} AS m0, {_N('ef')} AS e0, {_N('sf')} AS s0, {_N('raw_flat')} AS f0, epoch(end_ts) - epoch(start_ts) AS secs FROM typed)",
    "main0": f"SELECT order_id, user_id, station_id, status, start_ts, end_ts, secs, ef, sf, end_reason, channel, {rnd('coalesce(kwh, meter_kwh)', 3)} AS energy_kwh, date_trunc('day', start_ts) AS d0, {_NEXT} AS d1, {_END0} AS e0_ts, {_START1} AS s1_ts FROM judged WHERE discard_code = 0",
    "main1": f"SELECT *, {_split('peak')}, {_split('flat')}, {_split('valley')}, {_MIN()} AS duration_min, greatest(0.0, greatest({_N('ef')} + {_N('sf')}, 0.0)) AS disc, {end_class('end_reason')} AS end_reason_class FROM main0",
    "main": f"SELECT *, {rnd('disc', 2)} AS discount_amount, disc > 0 AS used_discount, {rnd('valley_kwh / CASE WHEN energy_kwh > 0 THEN energy_kwh END', 3)} AS valley_share, {rnd('energy_kwh / (CASE WHEN duration_min > 0 THEN duration_min END / 60)', 3)} AS avg_power_kw FROM main1",
    "numbered": "SELECT *, sum(is_new) OVER (PARTITION BY user_id ORDER BY start_ts, end_ts, order_id) AS session_no FROM (SELECT *, CASE WHEN user_id IS NOT NULL AND station_id = lag(station_id) OVER w AND epoch(start_ts) - epoch(lag(end_ts) OVER w) BETWEEN 0 AND 600 THEN 0 ELSE 1 END AS is_new FROM main WINDOW w AS (PARTITION BY user_id ORDER BY start_ts, end_ts, order_id))",
    "sessions0": "SELECT user_id, session_no, arg_min(order_id, (start_ts, end_ts, order_id)) AS order_id, arg_min(station_id, (start_ts, end_ts, order_id)) FILTER (station_id IS NOT NULL) AS station_id, "
    + ", ".join(f"{_DEC(c)} AS {c}" for c in ("energy_kwh", "peak_kwh", "flat_kwh", "valley_kwh", "discount_amount"))
    + ", min(start_ts) AS start_ts, max(end_ts) AS end_ts, bool_or(used_discount) AS used_discount, count(*) AS raw_orders FROM numbered GROUP BY user_id, session_no",
    "sessions1": f"SELECT *, {_MIN()} AS duration_min, raw_orders > 1 AS is_merged, {rnd('valley_kwh / CASE WHEN energy_kwh > 0 THEN energy_kwh END', 3)} AS valley_share FROM sessions0",
    "sessions": f"SELECT *, {_REUSE}, {gap('gap_h')} AS gap_bucket, user_seq = 1 AS is_first FROM ({_SEQ % 'sessions1'})",
    "daym": f"SELECT *, {_MIN()} AS duration_min, is_valid = {q(V.YES)} AS valid FROM charge_day",
    "seq": f"SELECT *, {_REUSE} FROM ({_SEQ % 'daym'})",
    "recent": f"SELECT * FROM seq WHERE {_NB} AND start_ts >= (SELECT max(start_ts) FROM charge_day WHERE {_NB}) - INTERVAL 90 DAY",
    "base0": f"SELECT *, {rnd('discount_amount / nullif(paid_amount + discount_amount, 0)')} AS discount_share, {rnd('paid_amount / nullif(CASE WHEN energy_kwh > 0 THEN energy_kwh END, 0)')} AS unit_price, {rnd('energy_kwh * 60 / CASE WHEN duration_min > 0 THEN duration_min END', 3)} AS power_kw, {hour_label('start_ts')} AS hour_label FROM recent",
    "base": "SELECT *, " + ", ".join(f"coalesce({c}, false) AS {k}" for k, c in _FLAGS.items()) + " FROM base0",
    "valid": "SELECT * FROM base WHERE trim(coalesce(user_id, '')) <> '' AND valid",
    "features": "SELECT user_id, count(*) AS n_orders, count(DISTINCT year(start_ts)) AS n_years, count(DISTINCT strftime(start_ts, '%Y-%m')) AS n_months, count(DISTINCT CAST(start_ts AS DATE)) AS n_days, min(start_ts) AS first_ts, max(start_ts) AS last_ts, "
    + ", ".join(f"count(*) FILTER ({f}) AS n_{f}" for f in _FLAGS)
    + f", {_DEC('energy_kwh')} AS sum_kwh, CAST(sum(CAST(energy_kwh AS DECIMAL(18,4))) AS DOUBLE) / count(energy_kwh) AS avg_kwh, median(energy_kwh) AS median_kwh, avg(duration_min) AS avg_minutes, median(duration_min) AS median_minutes, avg(power_kw) AS avg_power, CAST(sum(CAST(valley_share AS DECIMAL(18,4))) AS DOUBLE) / count(valley_share) AS avg_valley_share, {_DEC('paid_amount')} AS sum_paid, avg(paid_amount) AS avg_paid, avg(unit_price) AS avg_unit_price, {_DEC('discount_amount')} AS sum_discount, avg(discount_share) AS avg_discount_share, avg(gap_h) AS avg_gap_h, median(gap_h) AS median_gap_h, count(gap_h) AS n_gaps FROM valid GROUP BY user_id",
    "sample": "SELECT max(start_ts) AS sample_max FROM base",
    "ratios": "SELECT features.*, date_diff('day', CAST(last_ts AS DATE), CAST(sample_max AS DATE)) AS days_since_last, greatest(date_diff('day', CAST(first_ts AS DATE), CAST(sample_max AS DATE)) + 1, 14) AS span_days, CAST(greatest(date_diff('day', CAST(first_ts AS DATE), CAST(sample_max AS DATE)) + 1, 14) AS DOUBLE) / n_orders AS days_per_order, "
    + ", ".join(f"n_{f} / CAST(n_orders AS DOUBLE) AS share_{f}" for f in _FLAGS)
    + " FROM features CROSS JOIN sample",
    "ranked": _rank("valid", {"station": "station_id", "hour": "hour_label", "method": "charge_method", "channel": "channel", "charger": "charger_id", "reason": "abnormal_reason"}),
    "conc_station": _conc("station", ("top_station", "station2", "station3")),
    "conc_hour": _conc("hour", ("top_hour1", "top_hour2", "top_hour3")),
    "wide": "SELECT ratios.*, " + ", ".join(f"coalesce(s.{c}, 0) AS {c}" for c in ("station_share1", "station_share2", "station_share3", "station_top2", "station_top3", "station_min2", "station_min3", "n_stations")) + ", top_station, station2, station3, "
    + ", ".join(f"coalesce(h.{c}, 0) AS {c}" for c in ("hour_share1", "hour_share2", "hour_share3", "hour_top2", "hour_top3", "hour_min2", "hour_min3", "n_hours")) + ", top_hour1, top_hour2, top_hour3, t.* EXCLUDE (user_id) FROM ratios LEFT JOIN conc_station s USING (user_id) LEFT JOIN conc_hour h USING (user_id) LEFT JOIN (SELECT user_id, "
    + ", ".join(f"max(CASE WHEN attribute = '{a}' THEN value END) AS top_{a}" for a in ("method", "channel", "charger", "reason")) + " FROM ranked WHERE rn = 1 GROUP BY user_id) t USING (user_id)",
    "scored": f"SELECT *, {r_score('days_since_last')} AS r_score, {f_score('days_per_order')} AS f_score, {m_score('avg_kwh')} AS m_score FROM wide",
    "segs": f"SELECT *, {pick('r_score', V.R_LEVELS)} AS r_level, {pick('f_score', V.F_LEVELS)} AS f_level, {pick('m_score', V.M_LEVELS)} AS m_level, {rfm('r_score', 'f_score', 'm_score')} AS rfm_type, r_score + f_score + m_score AS rfm_total, "
    "CASE WHEN share_used_discount >= 0.5 OR avg_valley_share >= 0.5 THEN '高价格敏感' WHEN share_used_discount >= 0.2 OR avg_valley_share >= 0.25 THEN '中价格敏感' ELSE '低价格敏感' END AS price_level, "
    f"{station_pref()} AS station_pref, {time_pref()} AS time_pref, CASE WHEN share_is_risk >= 0.2 OR share_is_fault_end >= 0.1 OR share_is_overlong >= 0.2 THEN '高风险' WHEN share_is_risk >= 0.05 OR share_is_fault_end >= 0.03 OR share_is_overlong >= 0.05 THEN '中风险' ELSE '低风险' END AS risk_level FROM scored",
    "labels": f"SELECT *, coalesce(nullif(concat_ws('；', CASE WHEN rfm_type IN ({_HV}, {q(V.HV_RISK)}) THEN rfm_type END, CASE WHEN f_level IN ('高频', '中高频') THEN '高频用户' END, CASE WHEN r_level IN ('沉默风险', '沉默') THEN '沉默风险用户' END, CASE WHEN price_level = '高价格敏感' THEN '价格敏感用户' END, CASE WHEN station_pref = '固定站点用户' THEN '固定站点用户' END, CASE WHEN risk_level = '高风险' THEN '异常风险用户' END), ''), {q(V.GENERAL)}) AS user_labels FROM segs",
    "profile": "SELECT *, concat_ws('；', '活跃度:' || r_level, '频次:' || f_level, '价值:' || m_level, '价格:' || price_level, '站点:' || station_pref, '时段:' || time_pref, '风险:' || risk_level) AS behavior_pattern FROM labels",
    "daily": f"SELECT user_id, CAST(start_ts AS DATE) AS order_date, count(*) AS orders, sum(CAST(coalesce(energy_kwh, 0) AS DECIMAL(18,3))) AS kwh, max(start_ts) AS last_ts FROM charge_day WHERE {_NB} AND trim(coalesce(user_id, '')) <> '' GROUP BY ALL",
    "ends": "SELECT DISTINCT CAST(unnest(list_append(generate_series(hi, low, INTERVAL (-1) DAY), CAST(low AS TIMESTAMP))) AS DATE) AS win_end FROM (SELECT max(order_date) AS hi, greatest(max(order_date) - 90, min(order_date)) AS low FROM daily)",
    "roll0": "SELECT win_end, user_id, sum(orders) AS n_orders, max(last_ts) AS last_ts, min(order_date) AS first_date, sum(kwh) AS kwh FROM daily JOIN ends ON order_date BETWEEN win_end - 89 AND win_end GROUP BY ALL",
    "roll1": "SELECT win_end - 89 AS win_start, win_end, user_id, n_orders, last_ts, date_diff('day', CAST(last_ts AS DATE), win_end) AS days_to_end, greatest(date_diff('day', first_date, win_end) + 1, 14) AS span_days, CAST(kwh AS DOUBLE) / CAST(n_orders AS DOUBLE) AS avg_kwh FROM roll0",
    "roll2": f"SELECT *, CAST(span_days AS DOUBLE) / CAST(n_orders AS DOUBLE) AS days_per_order, {r_score('days_to_end')} AS r_score, {f_score('CAST(span_days AS DOUBLE) / CAST(n_orders AS DOUBLE)')} AS f_score, {m_score('avg_kwh')} AS m_score FROM roll1",
    "snaps": f"SELECT *, {rfm('r_score', 'f_score', 'm_score')} AS rfm_type FROM roll2",
    "runs": "SELECT user_id, run, rfm_type, min(win_start) AS seg_start, max(win_end) AS seg_end, count(*) AS n_windows FROM (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY win_end) AS run FROM (SELECT *, CASE WHEN rfm_type = lag(rfm_type) OVER (PARTITION BY user_id ORDER BY win_end) THEN 0 ELSE 1 END AS c FROM snaps)) GROUP BY ALL",
    "periods": f"SELECT user_id, rfm_type, seg_start, seg_end, n_windows, coalesce(lag(rfm_type) OVER w, {q(V.NONE)}) AS prev_type, coalesce(lead(rfm_type) OVER w, {q(V.NONE)}) AS next_type FROM runs WINDOW w AS (PARTITION BY user_id ORDER BY run)",
    "traj": f"SELECT user_id, min(seg_start) AS hv_start, max(seg_end) AS hv_end, sum(n_windows) AS hv_windows, count(*) AS hv_segments, arg_min(prev_type, seg_start) AS first_prev, arg_max(next_type, seg_end) AS last_next FROM periods WHERE rfm_type = {_HV} GROUP BY user_id",
    "states": f"SELECT *, CASE WHEN user_id NOT IN (SELECT user_id FROM snaps WHERE win_end = (SELECT max(win_end) FROM snaps)) THEN {q(V.SILENT)} WHEN last_next = {q(V.NONE)} AND hv_segments > 1 THEN {q(V.RETURNING)} WHEN last_next = {q(V.NONE)} THEN {q(V.STABLE)} ELSE {q(V.EXITED)} END AS hv_state FROM traj",
    "lbase": f"SELECT * FROM (SELECT *, CAST(start_ts AS DATE) AS d, (SELECT max(CAST(start_ts AS DATE)) FROM charge_day WHERE {_NB}) AS end_date, CASE WHEN abnormal_reason <> '' THEN abnormal_reason ELSE end_reason_class END AS reason_text FROM charge_day WHERE {_NB} AND trim(coalesce(user_id, '')) <> '') WHERE d >= end_date - 179",
    "news": "SELECT user_id, min(start_ts) AS first_ts, max(start_ts) AS last_ts, count(*) AS orders_horizon, count(*) FILTER (d >= end_date - 6) AS orders_recent FROM lbase GROUP BY user_id HAVING min(d) >= max(end_date) - 6",
    "returns": "SELECT e.*, s.orders_horizon, s.orders_before, s.orders_recent FROM (SELECT user_id, prev_date, d AS return_date, date_diff('day', prev_date, d) AS gap_days FROM (SELECT *, lag(d) OVER (PARTITION BY user_id ORDER BY d) AS prev_date FROM (SELECT DISTINCT user_id, d, end_date FROM lbase)) WHERE date_diff('day', prev_date, d) > 30 AND d >= end_date - 6) e JOIN (SELECT user_id, count(*) AS orders_horizon, count(*) FILTER (d < end_date - 6) AS orders_before, count(*) FILTER (d >= end_date - 6) AS orders_recent FROM lbase GROUP BY user_id) s USING (user_id)",
    "flagged": f"SELECT r.*, m.seg_start, m.seg_end, s.hv_state AS ever_hv_state, m.seg_start IS NOT NULL AS was_hv, s.hv_state IS NOT NULL AS ever_hv, CASE WHEN m.seg_start IS NOT NULL THEN coalesce(s.hv_state, {q(V.YES)}) END AS hv_state_before FROM returns r LEFT JOIN (SELECT r.user_id, r.return_date, min(p.seg_start) AS seg_start, arg_min(p.seg_end, p.seg_start) AS seg_end FROM returns r JOIN periods p ON r.user_id = p.user_id AND p.rfm_type = {_HV} AND r.prev_date BETWEEN p.seg_start AND p.seg_end GROUP BY ALL) m USING (user_id, return_date) LEFT JOIN states s USING (user_id)",
    "abnormal": f"SELECT user_id, min(a) AS first_ts, max(b) AS last_ts, sum(n) AS abnormal_orders, count(*) AS reason_kinds, string_agg(reason || '(' || n || ')', '；' ORDER BY n DESC, reason) AS reason_detail, first(reason ORDER BY n DESC, reason) AS main_reason FROM (SELECT user_id, reason_text AS reason, count(*) AS n, min(start_ts) AS a, max(start_ts) AS b FROM lbase WHERE d >= end_date - 13 AND {any_of('reason_text', V.ABNORMAL_WORDS)} AND NOT {any_of('reason_text', V.NORMAL_WORDS)} GROUP BY ALL) GROUP BY user_id",
    "lastmain": "SELECT max(CAST(last_ts AS DATE)) AS last_day FROM labels",
    "final0": f"SELECT m.*, CASE WHEN s.hv_state = {q(V.SILENT)} THEN {q(V.EXITED)} ELSE coalesce(s.hv_state, '') END AS hv_state, s.hv_segments, s.hv_end, n.user_id IS NOT NULL AS is_new, f.ever AS ever, a.user_id IS NOT NULL AS is_abnormal, last_day FROM labels m LEFT JOIN states s USING (user_id) LEFT JOIN news n USING (user_id) LEFT JOIN (SELECT user_id, bool_or(ever_hv) AS ever FROM flagged GROUP BY user_id) f USING (user_id) LEFT JOIN abnormal a USING (user_id) CROSS JOIN lastmain",
    "final": f"SELECT *, CASE WHEN is_new THEN '01' WHEN NOT ever THEN '02' WHEN hv_state = {q(V.STABLE)} THEN '03' WHEN hv_state = {q(V.RETURNING)} THEN '04' WHEN hv_state = {q(V.EXITED)} THEN '05' WHEN r_score <= 2 AND f_score >= 4 THEN '06' WHEN r_score >= 4 AND f_score <= 2 AND m_score >= 4 THEN '07' WHEN f_score <= 2 AND m_score <= 2 THEN '08' WHEN f_score >= 4 AND m_score <= 2 THEN '09' ELSE '11' END AS segment_code, date_diff('day', hv_end, last_day) AS days_since_hv_exit, "
    "CASE WHEN n_orders < 3 THEN '样本不足' WHEN share_used_discount < 0.2 THEN '低' WHEN share_used_discount < 0.5 THEN '中' ELSE '高' END AS coupon_level, CASE WHEN n_orders < 3 OR avg_valley_share IS NULL THEN '样本不足' WHEN avg_valley_share < 0.25 THEN '低' WHEN avg_valley_share < 0.5 THEN '中' ELSE '高' END AS valley_level, n_orders = 1 AND m_score >= 4 AS single_high FROM final0",
    "silent": f"SELECT s.*, date_diff('day', hv_end, (SELECT last_day FROM lastmain)) AS days_since_hv_exit FROM states s WHERE hv_state = {q(V.SILENT)} AND user_id NOT IN (SELECT user_id FROM labels)",
    "rep": f"SELECT *, hour(start_ts) AS start_hour, {weekday('start_ts')} AS weekday, {band('hour(start_ts)', V.SHORT_PERIODS)} AS short_period, year(start_ts) AS year, {group('duration_min', V.DURATION_DETAIL)} AS duration_detail, {group('duration_min', V.DURATION_CORE)} AS duration_core, CASE WHEN duration_min <= 30 AND energy_kwh <= 20 THEN '短时低电量' WHEN duration_min <= 30 AND energy_kwh > 20 THEN '短时高电量' WHEN duration_min > 120 AND energy_kwh > 40 THEN '长时高电量' WHEN duration_min > 120 AND energy_kwh <= 20 THEN '长时低电量' ELSE '常规补能' END AS energy_type FROM seq WHERE valid",
    "dims": f"SELECT station_key, station_name, place, category FROM (SELECT *, {station_key('station_id')} AS station_key, {category('station_type')} AS category, row_number() OVER (PARTITION BY {station_key('station_id')} ORDER BY station_name, station_id) AS n FROM station) WHERE n = 1 AND station_key IS NOT NULL",
}

_DEPS = {k: [b for b in BLOCKS if b != k and re.search(rf"\b(?:FROM|JOIN)\s+\(*{b}\b", v)] for k, v in BLOCKS.items()}


def oracle(select: str) -> str:
    """The select with the blocks it needs in front, in order of dependence."""
    order: list[str] = []

    def need(name: str) -> None:
        for d in _DEPS[name]:
            if d not in order:
                need(d)
        if name not in order:
            order.append(name)

    for b in BLOCKS:
        if re.search(rf"\b(?:FROM|JOIN)\s+\(*{b}\b", select):
            need(b)
    if not order:
        return select
    return "WITH " + ",\n".join(f"{b} AS ({BLOCKS[b].strip()})" for b in order) + "\n" + select
