"""Scalar rules as Column functions: text, time, buckets, scores. All run inside Spark; none is a Python UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import values as V


def chain(cases: list[tuple[Column, object]], default: object = None) -> Column:
    """First condition that holds gives the value; a null condition does not hold."""
    out = F
    for condition, value in cases:
        out = out.when(condition, value if isinstance(value, Column) else F.lit(value))
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def any_of(text: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


# ---- text
def normalize_text(x: Column, unknown: str | None = None) -> Column:
    text = F.regexp_replace(F.trim(x.cast("string")), r"^(\d+)\.0$", "$1")
    return F.when(text.isNull() | text.isin(*V.NULL_TEXTS), F.lit(unknown)).otherwise(text)


def normalize_category(x: Column) -> Column:
    return normalize_text(x, V.UNKNOWN)


def normalize_station_key(x: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(normalize_text(x), "^(?i:station-)", "")), F.lit(""))


def normalize_station_type(x: Column) -> Column:
    return F.nullif(F.regexp_replace(F.translate(normalize_text(x), "（）", "()"), r"\s+", ""), F.lit(""))


def station_type_to_category(x: Column) -> Column:
    kind = normalize_station_type(x)
    return chain([(kind.isin(*names), category) for category, names in V.STATION_TYPES.items()], V.OTHER)


def safe_divide(a: Column, b: Column, default: float | None = None) -> Column:
    out = F.try_divide(a, b)
    return out if default is None else F.coalesce(out, F.lit(default))


def round_n(x: Column | str, places: int) -> Column:
    """Half up on decimals, so that a tie does not hang on the last bit of a double."""
    return F.round((F.col(x) if isinstance(x, str) else x).cast("decimal(38,12)"), places).cast("double")


def clean_text(x: Column, default: str = "") -> Column:
    text = F.trim(x.cast("string"))
    return F.when(text.isNull() | text.isin("", "nan", "NaN"), F.lit(default)).otherwise(text)


def is_yes(x: Column) -> Column:
    return F.coalesce(F.lower(F.trim(x.cast("string"))).isin(*V.YES_TEXTS), F.lit(False))


def yes_no(x: Column) -> Column:
    return F.when(x, F.lit(V.YES)).otherwise(F.lit(V.NO))


def safe_ident(x: Column) -> Column:
    """Relative file path without its ending -> table name."""
    part = F.trim(F.regexp_replace(F.regexp_replace(x, r"[^\w一-鿿]+", "_"), "_+", "_"), F.lit("_"))
    part = F.when(part == "", F.lit("table")).otherwise(part)
    return F.substring(F.when(part.rlike(r"^\d"), F.concat(F.lit("t_"), part)).otherwise(part), 1, 60)


def source_table_year(name: Column) -> Column:
    text = F.trim(name)
    two = F.nullif(F.regexp_extract(text, r"^[yY](\d{2})(?!\d)", 1), F.lit(""))
    four = F.nullif(F.regexp_extract(text, r"^[yY](20\d{2})(?!\d)", 1), F.lit(""))
    inner = F.nullif(F.regexp_extract(text, r"[_\-.][yY](\d{2})(?!\d)", 1), F.lit(""))
    plain = F.nullif(F.regexp_extract(text, r"(20\d{2})", 1), F.lit(""))
    return F.coalesce(two.cast("int") + 2000, four.cast("int"), inner.cast("int") + 2000, plain.cast("int"))


def join_reasons(reasons: Column) -> Column:
    """Array of texts -> distinct ones that are not empty, order kept, joined."""
    return F.array_join(F.array_distinct(F.filter(reasons, lambda r: r.isNotNull() & (r != ""))), "；")


def classify_end_reason(x: Column) -> Column:
    text = normalize_text(x, V.UNKNOWN)
    cases = [(any_of(text, words), label) for label, words in V.END_WORDS]
    return chain([*cases, (any_of(F.upper(text), V.END_CODES), V.END_FAULT)], V.END_OTHER)


def abnormal_text(x: Column) -> Column:
    """Any abnormal word and no normal one."""
    return any_of(x, V.ABNORMAL_WORDS) & ~any_of(x, V.NORMAL_WORDS)


# ---- time
def _band(hour: Column, labels) -> Column:
    return chain([(hour.isNull(), V.UNKNOWN), (hour <= 5, labels[0]), (hour <= 11, labels[1]), (hour <= 17, labels[2])], labels[3])


def rough_period(hour: Column) -> Column:
    return _band(hour, V.PERIODS)


def short_period(hour: Column) -> Column:
    return _band(hour, V.SHORT_PERIODS)


def hour_label(ts: Column) -> Column:
    h = F.lpad(F.hour(ts).cast("string"), 2, "0")
    return F.when(ts.isNull(), F.lit(V.UNKNOWN)).otherwise(F.concat(h, F.lit(":00-"), h, F.lit(":59")))


def normalize_period(text: Column) -> Column:
    digits = F.regexp_extract(F.coalesce(text, F.lit("")), r"(?:^|[^0-9])(\d{1,2})", 1)
    h = F.lpad(clamp(F.nullif(digits, F.lit("")).cast("int"), 0, 23).cast("string"), 2, "0")
    return F.coalesce(F.concat(h, F.lit(":00-"), h, F.lit(":59")), F.lit(V.UNKNOWN))


def weekday_name(ts: Column) -> Column:
    return F.coalesce(F.element_at(F.array(*[F.lit(w) for w in V.WEEKDAYS]), F.weekday(ts) + 1), F.lit(V.UNKNOWN))


def is_weekend(ts: Column) -> Column:
    return F.coalesce(F.weekday(ts) >= 5, F.lit(False))


def is_cross_day(start: Column, end: Column) -> Column:
    return F.coalesce(F.to_date(start) != F.to_date(end), F.lit(False))


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))


# ---- buckets
def right_closed(x: Column, bins, below: str | None = None) -> Column:
    """Right-closed bins of (limit, label), the last with limit None; below zero and null give ``below``."""
    cases = [(x.isNull() | (x < 0), below), *((x <= limit, label) for limit, label in bins if limit is not None)]
    return chain(cases, bins[-1][1])


def duration_bucket_13(minutes: Column) -> Column:
    return chain([(minutes.isNull(), V.UNKNOWN), (minutes < 0, "时间异常"), (minutes == 0, "0min"), *((minutes <= a, b) for a, b in V.DURATION_13)], V.DURATION_OVER)


def duration_bucket_3(minutes: Column) -> Column:
    return chain([(minutes.isNull(), V.UNKNOWN), (minutes <= 30, "短时"), (minutes <= 240, "正常")], "超长")


def energy_bucket(kwh: Column) -> Column:
    return chain([(kwh.isNull(), V.UNKNOWN), (kwh == 0, "0kWh"), *((kwh <= a, b) for a, b in V.ENERGY if a is not None)], V.ENERGY[-1][1])


def interval_bucket(hours: Column) -> Column:
    return chain([(hours.isNull(), V.FIRST), *((hours <= a, b) for a, b in V.GAPS if a is not None)], V.GAPS[-1][1])


def duration_detail_group(minutes: Column) -> Column:
    return right_closed(minutes, V.DURATION_DETAIL)


def duration_core_group(minutes: Column) -> Column:
    return right_closed(minutes, V.DURATION_CORE)


def energy_duration_type(minutes: Column, kwh: Column) -> Column:
    short_low, short_high, common, long_high, long_low = V.ENERGY_TYPES
    return chain([((minutes <= 30) & (kwh <= 20), short_low), ((minutes <= 30) & (kwh > 20), short_high), ((minutes > 120) & (kwh > 40), long_high), ((minutes > 120) & (kwh <= 20), long_low)], common)


def clamp(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(high)), F.lit(low)))


# ---- scores and labels
#: days and days per order after which the scores of recency and frequency rise, in any window
R_LIMITS, F_LIMITS = (7, 14, 30, 60, 90), (4, 7, 14, 20)


def r_score(days: Column, window_days: int = 90) -> Column:
    limits = (*R_LIMITS[:3], R_LIMITS[4] if window_days >= 180 else R_LIMITS[3])
    return chain([(days <= d, k) for k, d in enumerate(limits, 1)], 5)


def f_score(days_per_order: Column) -> Column:
    return chain([(days_per_order <= d, k) for k, d in enumerate(F_LIMITS, 1)], 5)


def m_score(kwh: Column) -> Column:
    return chain([(kwh >= 40, 5), (kwh >= 30, 4), (kwh >= 20, 3), (kwh >= 10, 2)], 1)


def level(score: Column, names) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), score)


def rfm_type(r: Column, f: Column, m: Column) -> Column:
    return chain(
        [((r <= 2) & (f <= 2) & (m >= 4), V.HV_ACTIVE), ((r >= 4) & (f <= 2) & (m >= 4), V.HV_RISK), ((r <= 2) & (f >= 4), V.NEW_LOW), ((f <= 2) & (m < 3), V.HIGH_LOW), ((f >= 4) & (m <= 2), V.LOW_LOW)],
        V.GENERAL,
    )


def price_sensitivity(coupon: Column, valley: Column) -> Column:
    return chain([((coupon >= 0.5) | (valley >= 0.5), "高价格敏感"), ((coupon >= 0.2) | (valley >= 0.25), "中价格敏感")], "低价格敏感")


def station_preference(n: Column, top1: Column, top2: Column, top3: Column, min2: Column, min3: Column, stations: Column) -> Column:
    return chain(
        [(n <= 5, V.TOO_FEW), (top1 >= 0.5, "固定站点用户"), ((top2 >= 0.6) & (min2 >= 0.2), "双站点用户"), ((top3 >= 0.7) & (min3 >= 0.1), "三站点用户"), (stations >= 5, "多站流动用户")],
        "一般站点用户",
    )


def time_preference(n: Column, top1: Column, top2: Column, second: Column, top3: Column, third: Column) -> Column:
    return chain(
        [(n <= 5, V.TOO_FEW), (top1 >= 0.5, "单时段偏好"), ((top2 >= 0.6) & (second >= 0.15), "双时段偏好"), ((top3 >= 0.7) & (third >= 0.1), "三时段偏好"), (top1 >= 0.3, "轻度时段偏好")],
        "无明显偏好",
    )


def risk_level(risk: Column, fault: Column, overlong: Column) -> Column:
    return chain([((risk >= 0.2) | (fault >= 0.1) | (overlong >= 0.2), "高风险"), ((risk >= 0.05) | (fault >= 0.03) | (overlong >= 0.05), "中风险")], "低风险")


def user_labels(rfm: Column, f: Column, r: Column, price: Column, station: Column, risk: Column) -> Column:
    made = F.array(
        F.when(rfm.isin(V.HV_ACTIVE, V.HV_RISK), rfm),
        F.when(f.isin("高频", "中高频"), F.lit("高频用户")),
        F.when(r.isin("沉默风险", "沉默"), F.lit("沉默风险用户")),
        F.when(price == "高价格敏感", F.lit("价格敏感用户")),
        F.when(station == "固定站点用户", F.lit("固定站点用户")),
        F.when(risk == "高风险", F.lit("异常风险用户")),
    )
    return F.coalesce(F.nullif(join_reasons(made), F.lit("")), F.lit(V.GENERAL))


def level_of(value: Column, n: Column, least: int, high: float, mid: float) -> Column:
    enough = F.coalesce(n, F.lit(0)) >= least
    return chain([(enough & (value < mid), "低"), (enough & (value >= mid) & (value < high), "中"), (enough & (value >= high), "高")], V.TOO_FEW)


def fill_none(x: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(x), F.lit("")), F.lit(V.NONE))


def silence_tier(days: Column) -> Column:
    return chain([((days >= a) & (days <= b), k) for k, (a, b) in enumerate(((8, 15), (16, 30), (31, 60), (61, 90), (91, 180)), 1)])


def month_discount(kwh: Column) -> Column:
    """Percent of the price to pay by the month's energy."""
    return chain([(kwh <= 50, 99), (kwh <= 100, 95), (kwh <= 200, 90), (kwh <= 300, 85)], 80)
