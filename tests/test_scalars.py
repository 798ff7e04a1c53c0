"""Scalar rules on hand-made values."""

from pyspark.sql import functions as F

from ampereflow import values as V
from ampereflow.functions import scalars as S


def values(spark, fn, items, kind="string"):
    rows = [(k, None if x is None else x) for k, x in enumerate(items)]
    df = spark.createDataFrame(rows, f"k int, x {kind}").select("k", fn(F.col("x")).alias("y")).orderBy("k")
    return [r["y"] for r in df.collect()]


def test_text_ids(spark):
    assert values(spark, S.normalize_text, ["123.0", " ", "nan", "无", "a ", None, "1.50"]) == ["123", None, None, None, "a", None, "1.50"]
    assert values(spark, S.normalize_station_key, ["Station-9", "STATION-3", " 4", "station-", "7.0"]) == ["9", "3", "4", None, "7"]
    assert values(spark, S.normalize_station_type, ["单位内部（专用）", " 公 交 ", ""]) == ["单位内部(专用)", "公交", None]
    assert values(spark, S.station_type_to_category, ["高速", "城市公共", "单位内部（专用）", "公交", "岸电", None]) == ["高速", "公共场站", "专用场站", "公交场站", "其他", "其他"]
    assert values(spark, S.safe_ident, ["9 a/b", "数据-1", "--"]) == ["t_9_a_b", "数据_1", "table"]
    assert values(spark, S.source_table_year, ["y26_m1_t_2601", "Y2025_x", "t_y24_a", "t_2023_1", "abc"]) == [2026, 2025, 2024, 2023, None]
    assert values(spark, S.normalize_period, ["晚上22点", "7", "99", "无", None]) == ["22:00-22:59", "07:00-07:59", "23:00-23:59", V.UNKNOWN, V.UNKNOWN]


def test_end_reasons(spark):
    assert values(spark, S.classify_end_reason, ["电动汽车充满", "用户拔枪", "预充金额用完", "后台停止", "绝缘故障", "0253h", "12345", None]) == ["正常结束", "用户主动停止", "金额/SOC达到", "后台/系统结束", "故障异常", "故障异常", "其他原因", "其他原因"]


def test_bins(spark):
    assert values(spark, S.duration_bucket_13, [0.0, 10.0, 10.001, 720.0, 720.1, -1.0, None], "double") == ["0min", "0-10min", "10-20min", "360-720min", "720min以上", "时间异常", "未知"]
    assert values(spark, S.energy_bucket, [0.0, -3.0, 10.0, 80.5, None], "double") == ["0kWh", "0-10kWh", "0-10kWh", "80kWh以上", "未知"]
    assert values(spark, S.interval_bucket, [None, 6.0, 336.0, 336.1], "double") == ["首次", "0-6h", "7-14天", "14天以上"]
    assert values(spark, S.duration_core_group, [0.0, 60.0, 121.0, -1.0], "double") == ["0-10min", "30-60min", "120min以上", None]


def test_scores(spark):
    assert values(spark, S.r_score, [7, 8, 14, 30, 60, 61], "int") == [1, 2, 2, 3, 4, 5]
    assert values(spark, S.f_score, [4.0, 7.0, 14.0, 20.0, 21.0, None], "double") == [1, 2, 3, 4, 5, 5]
    assert values(spark, S.m_score, [40.0, 30.0, 20.0, 10.0, 9.0, None], "double") == [5, 4, 3, 2, 1, 1]
    assert values(spark, lambda n: S.station_preference(n, *[F.lit(x) for x in (0.6, 0.6, 0.6, 0.0, 0.0, 1)]), [5, 6], "int") == [V.TOO_FEW, "固定站点用户"]
    assert values(spark, S.silence_tier, [7, 8, 15, 16, 90, 180, 181], "int") == [None, 1, 1, 2, 4, 5, None]
