"""Assets, mappings, density curves and yearly reports on micro tables."""

import math
from datetime import date as D
from datetime import datetime as T

from pyspark.sql import functions as F

from ampereflow import values as V
from ampereflow.operators import assets as A
from ampereflow.operators import features as P
from ampereflow.operators import reports as R
from ampereflow.plans import registry

ASSET = "station_id string, station_type string, place string, status string, longitude string, latitude string, since string"


def test_assets_are_judged_by_the_first_rule_that_holds(spark):
    rows = [("STATION-1", "高速", "x", "在运", "120.5", "30", "2021-05-06"), ("station-2", "高速", "x", " 退运 ", "999", None, None), (None, "高速", "x", "停运", None, None, None), ("4", None, "x", "在运", None, None, "n/a"), ("5", "公交", None, "待投运", "181", "10", ""), ("6", "公交", "x", None, "", " ", "2020-02-30"), ("7", "公交", "x", "停运", "7", "-91", None), (None,) * 7]
    judged = A.judge_assets(spark.createDataFrame(rows, ASSET))
    got = [(r["station_key"], r["status"], r["outcome"], r["since_year"]) for r in judged.collect()]
    assert got == [("1", "在运", "kept", 2021), ("2", V.RETIRED, "retired", None), (None, "停运", "no key", None), ("4", "在运", "no type", None), ("5", "待投运", "bad place", None), ("6", V.UNKNOWN, "kept", None), ("7", "停运", "bad place", None), (None, V.UNKNOWN, "no key", None)]
    kept, problems = A.split_assets(judged)
    assert (kept.count(), problems.count()) == (2, 5)
    assert {r["outcome"]: r["assets"] for r in A.asset_log(judged).collect()} == {"kept": 2, "retired": 1, "no key": 2, "no type": 1, "bad place": 2}
    assert A.asset_log(judged.limit(0)).count() == 0


def test_mapping_periods(spark):
    rows = [("1", "a", D(2020, 1, 31), D(2020, 3, 1)), ("station-2", "a", D(2020, 3, 1), None), ("2", "a", D(2020, 3, 1), None), ("3", "b", D(2019, 12, 1), D(2021, 1, 1)), (None, "b", D(2022, 1, 1), None), ("4", " ", D(2022, 1, 1), None)]
    got = sorted((r["charger_id"], r["station_key"], r["months"], r["is_latest"], r["mappings"]) for r in A.mapping_periods(spark.createDataFrame(rows, "station_id string, charger_id string, valid_from date, valid_to date")).collect())
    assert got == [("a", "1", 2, False, 2), ("a", "2", 10, True, 2), ("b", "3", 13, True, 1)]


def test_mapping_periods_in_parts(spark):
    """The same rows; with parts nothing is grouped or joined in tasks whose number stays while the table grows."""
    rows = [(str(k % 11), f"c{k % 37}", D(2020, 1, 1 + k % 28), D(2021, 1, 1 + k % 20) if k % 5 else None) for k in range(400)]
    df = spark.createDataFrame(rows + rows[:50], "station_id string, charger_id string, valid_from date, valid_to date")
    plain, parted = A.mapping_periods(df), A.mapping_periods(df, parts=7)
    assert plain.count() and sorted(map(str, plain.collect())) == sorted(map(str, parted.collect()))
    for got, parts in ((parted, 7), (registry.QUERIES["mapping_periods"](spark, "/root/testdata/sf0.01"), 4)):
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "ENSURE_REQUIREMENTS" not in "".join(x for x in plan.splitlines() if "hashpartitioning" in x) and f", {parts}), REPARTITION_BY_NUM" in plan


def test_valley_curves_against_plain_sums(spark):
    shares = {"公共场站": [0.1, 0.25, 0.25, 0.9], "高速": [0.5, 0.5], "其他": [0.0, 1.0]}
    rows = [(c, x) for c, xs in shares.items() for x in xs] + [("高速", None), ("公共场站", 1.5)]
    got = R.valley_curves(spark.createDataFrame(rows, "station_category string, valley_share double"), grid=5).collect()
    every = [x for xs in shares.values() for x in xs]
    for scope, xs in ((V.ALL_STATIONS, every), ("公共场站", shares["公共场站"])):
        n, mean = len(xs), sum(xs) / len(xs)
        bw = 1.1 * math.sqrt(sum((x - mean) ** 2 for x in xs) / (n - 1)) * n**-0.2
        want = {k / 4: round(sum(math.exp(-(((k / 4 - x) / bw) ** 2) / 2) for x in xs) / (n * bw * math.sqrt(2 * math.pi)), 4) for k in range(5)}
        assert {r["x"]: r["density"] for r in got if r["scope"] == scope} == want
    assert [(r["x"], r["density"], r["orders"]) for r in got if r["scope"] == "高速"] in ([(0.5, None, 2)],), "one value has no density"
    assert {r["scope"] for r in got} == {V.ALL_STATIONS, *V.CURVES}


def test_yearly_reports(spark):
    rows = [(2020, "凌晨", "App", 10.0, 1.0, V.YES), (2020, "凌晨", None, 20.0, 0.0, V.NO), (2020, "上午", " ", None, None, "首次充电"), (2021, None, "App", 1.0, 0.0, "站点缺失")]
    df = spark.createDataFrame(rows, "year int, short_period string, channel string, energy_kwh double, discount_amount double, reuse_station string")
    got = {(r["year"], r["field"], r["value"]): (r["orders"], r["share"]) for r in R.yearly_structure(df).collect()}
    assert got == {(2020, "period", "凌晨"): (2, 0.666667), (2020, "period", "上午"): (1, 0.333333), (2020, "channel", "App"): (1, 0.333333), (2020, "channel", V.UNKNOWN): (2, 0.666667), (2021, "period", V.UNKNOWN): (1, 1.0), (2021, "channel", "App"): (1, 1.0)}
    got = {r["year"]: tuple(r)[1:] for r in R.yearly_trends(df).collect()}
    assert got == {2020: (3, 15.0, 0.333333, 2, 0.5), 2021: (1, 1.0, 0.0, 0, None)}
    reasons = spark.createDataFrame([(T(2020, 1, 1), x) for x in ("b", "a", "b", "c", "a", None)] + [(T(2021, 1, 1), "c")], "start_ts timestamp, end_reason string")
    got = sorted((r["year"], r["rank"], r["reason"], r["orders"]) for r in R.yearly_top_reasons(reasons, 2).collect())
    assert got == [(2020, 1, "a", 2), (2020, 2, "b", 2), (2021, 1, "c", 1)]


def test_base_of_orders_that_lack_the_columns_of_some_sources(spark):
    row = [("1", "u", T(2024, 5, 1, 8), T(2024, 5, 1, 9), "s", "c", "高速", "慢充", "App", "正常结束", "", "是", 10.0, 5.0, 0.0, 0.3)]
    df = spark.createDataFrame(row, "order_id string, user_id string, start_ts timestamp, end_ts timestamp, station_id string, charger_id string, station_category string, charge_method string, channel string, end_reason_class string, abnormal_reason string, is_valid string, energy_kwh double, paid_amount double, discount_amount double, valley_share double")
    r = P.order_behavior_base(P.sequenced(df)).first()
    assert len(r) == 48 and (r["data_year"], r["user_code"], r["order_source"], r["peak_kwh"], r["used_discount"]) == (2024, None, V.UNKNOWN, None, False)
    more = df.withColumns({"source_table": F.lit("y23_m01"), "user_code": F.lit(" U "), "order_source": F.lit("平台"), "peak_kwh": F.lit(1.23456), "used_discount": F.lit("是")})
    r = P.order_behavior_base(P.sequenced(more)).first()
    assert (r["data_year"], r["natural_year"], r["user_code"], r["order_source"], r["peak_kwh"], r["used_discount"]) == (2023, 2024, "U", "平台", 1.235, True)
