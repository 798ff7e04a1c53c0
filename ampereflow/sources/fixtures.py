"""Charging orders read from the driver's tables: the projections that the queries and their SQL share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHARGE_DAY = """
WITH li AS (
  SELECT l_orderkey, min(l_suppkey) AS supp, min(l_partkey) AS part, avg(l_quantity) AS q, min(l_returnflag) AS rf,
         CAST(sum(CAST(l_extendedprice * l_discount AS DECIMAL(18,2))) AS DOUBLE) / 1000 AS disc
  FROM lineitem GROUP BY l_orderkey),
b AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_custkey % 60 AS h, o_orderstatus AS st, o_orderpriority AS ch, li.*,
         CAST(floor(((year(o_orderdate) - 1995) * 372 + (month(o_orderdate) - 1) * 31 + day(o_orderdate) - 1) / 8.0) AS INT) AS dn
  FROM orders JOIN li ON l_orderkey = o_orderkey),
g AS (
  SELECT b.*, k % 3 = 0 AND CASE WHEN h < 8 THEN dn < 200 WHEN h < 16 THEN dn >= 240
           WHEN h < 24 THEN dn < 225 OR dn >= 262 WHEN h < 32 THEN dn < 275
           WHEN h < 40 THEN dn < 170 OR dn >= 266 ELSE true END AS heavy
  FROM b),
f AS (
  SELECT g.*, CASE WHEN heavy THEN h ELSE 1000 + c END AS u,
         CASE WHEN heavy AND h % 3 = 0 THEN 8 + k % 3 ELSE (k * 7) % 24 END AS hh,
         CASE WHEN heavy AND h % 4 = 0 AND k % 5 > 0 THEN h + 1
              WHEN heavy AND h % 4 = 1 AND k % 10 > 1 THEN 1 + h % 7 + (k % 2) * 10
              WHEN heavy AND h % 4 = 2 AND k % 5 > 0 THEN 1 + h % 5 + (k % 9) * 5 ELSE supp END AS sn
  FROM g)
SELECT CAST(k AS STRING) AS order_id, 'U' || CAST(u AS STRING) AS user_id,
       CAST(DATE '2001-01-01' + dn AS TIMESTAMP) + INTERVAL '1' HOUR * hh + INTERVAL '1' MINUTE * (k % 60) AS start_ts,
       CAST(DATE '2001-01-01' + dn AS TIMESTAMP) + INTERVAL '1' HOUR * hh + INTERVAL '1' MINUTE * (k % 60 + 5 + (k * 13) % 290) AS end_ts,
       CAST(sn AS STRING) AS station_id, CAST(part AS STRING) AS charger_id,
       CASE sn % 6 WHEN 0 THEN '高速' WHEN 1 THEN '公共场站' WHEN 2 THEN '专用场站' WHEN 3 THEN '公共场站' WHEN 4 THEN '其他'
            ELSE CASE WHEN sn % 5 = 0 THEN '公交场站' ELSE '公共场站' END END AS station_category,
       CAST(floor(q * (600 + (u % 7) * 200)) AS DOUBLE) / 1000 AS energy_kwh, CAST(floor(q * 120) AS DOUBLE) / 100 AS paid_amount,
       CASE WHEN k % 4 = 0 THEN CAST(floor(disc * 100) AS DOUBLE) / 100 ELSE 0.0 END AS discount_amount,
       CAST((k * 11) % 100 AS DOUBLE) / 100 AS valley_share,
       ch AS channel, CASE st WHEN 'F' THEN 'App' WHEN 'O' THEN '小程序' ELSE '刷卡' END AS charge_method,
       CASE WHEN k % 29 = 0 THEN '故障异常' WHEN k % 31 = 0 THEN '其他原因' WHEN k % 2 = 0 THEN '正常结束' ELSE '用户主动停止' END AS end_reason_class,
       CASE WHEN k % 97 = 0 THEN '计量异常' ELSE '' END AS abnormal_reason,
       CASE WHEN k % 101 = 0 THEN '否' ELSE '是' END AS is_valid
FROM f
"""

CHARGE_RAW = """
WITH e AS (
  SELECT event_id AS k, user_id AS u, event_type AS et, value AS v, ts, event_id % 40 AS m,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 5 AS s,
         date_trunc('second', ts) + CASE WHEN user_id % 2 = 0 THEN INTERVAL '575' DAY ELSE INTERVAL '0' DAY END AS t0
  FROM events)
SELECT CAST(k AS STRING) AS order_id, CASE WHEN m = 39 THEN NULL ELSE CAST(u AS STRING) || '.0' END AS user_id,
       CASE WHEN m % 3 = 0 THEN 'STATION-' WHEN m % 3 = 1 THEN 'station-' ELSE ' ' END || CAST(s AS STRING) AS station_id,
       CASE WHEN m = 1 THEN '废弃' WHEN m = 2 THEN '无' ELSE '支付完成' END AS status,
       CASE WHEN m = 16 THEN '0000-00-00 00:00:00' WHEN m = 17 THEN '2019-12-31 23:59:59' ELSE substring(CAST(t0 AS STRING), 1, 19) END AS start_time,
       CASE WHEN m = 17 THEN '2020-01-01 00:30:00' ELSE substring(CAST(t0 + CASE WHEN m = 10 THEN INTERVAL '-60' SECOND WHEN m = 15 THEN INTERVAL '70000' SECOND
            WHEN m > 18 THEN INTERVAL '1' SECOND * (60 + (k * 37) % 3000)
            ELSE INTERVAL '1' SECOND * (60 + (k * 37) % 20000) END AS STRING), 1, 19) END AS end_time,
       CASE WHEN m = 2 THEN 801.0 WHEN m = 7 THEN -1.0 WHEN m IN (11, 12) THEN 0.05 WHEN m = 18 THEN NULL ELSE CAST(floor(v * 200) AS DOUBLE) / 1000 + 1 END AS kwh,
       CASE WHEN m = 2 THEN 801.0 WHEN m = 3 THEN 801.0 WHEN m = 9 THEN -1.0 WHEN m = 7 THEN -1.0 WHEN m IN (11, 12) THEN 0.05 WHEN m = 13 THEN CAST(floor(v * 200) AS DOUBLE) / 1000 + 2 ELSE CAST(floor(v * 200) AS DOUBLE) / 1000 + 1 END AS meter_kwh,
       CASE WHEN m = 4 THEN 501.0 WHEN m = 6 THEN 450.0 WHEN m = 8 THEN 450.0 WHEN m = 12 THEN 0.0 ELSE CAST(floor(v * 10) AS DOUBLE) / 100 + 1 END AS ef,
       CASE WHEN m = 5 THEN 501.0 WHEN m = 6 THEN 450.0 WHEN m = 12 THEN 0.0 ELSE CAST(floor(v * 5) AS DOUBLE) / 100 END AS sf,
       CASE WHEN m = 14 THEN 0.0 WHEN m = 2 THEN 801.0 WHEN m = 7 THEN -1.0 WHEN m IN (11, 12) THEN 0.05 ELSE CAST(floor(v * 200) AS DOUBLE) / 1000 + 1 END AS flat_kwh,
       CASE et WHEN 'click' THEN '用户拔枪' WHEN 'view' THEN '电动汽车充满' WHEN 'error' THEN '绝缘故障' WHEN 'signup' THEN '预充金额用完' ELSE '12345' END AS end_reason,
       et AS channel
FROM e
"""

STATION = """
SELECT CAST(s_suppkey AS STRING) AS station_id,
       CASE s_suppkey % 6 WHEN 0 THEN '高速' WHEN 1 THEN '城市公共' WHEN 2 THEN '单位内部(专用)' WHEN 3 THEN '公交' WHEN 4 THEN '岸电' END AS station_type,
       n_name AS place, s_name AS station_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""

BRIDGE = "SELECT 'u' || CAST(s_suppkey AS STRING) AS station_uuid, CAST(s_suppkey AS STRING) AS station_code FROM supplier WHERE s_suppkey % 2 = 0"

ASSET = """
SELECT CASE s_suppkey % 3 WHEN 0 THEN 'STATION-' WHEN 1 THEN 'station-' ELSE ' ' END || CAST(s_suppkey AS STRING) AS station_id,
       CASE s_suppkey % 6 WHEN 0 THEN '高速' WHEN 1 THEN '城市公共' WHEN 2 THEN '单位内部(专用)' WHEN 3 THEN '公交' WHEN 4 THEN '岸电' END AS station_type,
       n_name AS place, CASE s_suppkey % 9 WHEN 0 THEN ' 退运 ' WHEN 1 THEN '待投运' WHEN 2 THEN '停运' WHEN 3 THEN ' ' ELSE '在运' END AS status,
       CASE WHEN s_suppkey % 13 = 0 THEN NULL WHEN s_suppkey % 11 = 0 THEN 'E120' ELSE CAST(s_suppkey % 200 AS STRING) END AS longitude,
       CAST(s_nationkey * 3 AS STRING) AS latitude, CASE WHEN s_suppkey % 8 = 0 THEN '待定' ELSE CAST(CAST(since AS DATE) AS STRING) END AS since
FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN (SELECT l_suppkey, min(l_shipdate) AS since FROM lineitem GROUP BY l_suppkey) ON l_suppkey = s_suppkey
"""

MAPPING = """
SELECT 'station-' || CAST(l_suppkey AS STRING) AS station_id, CAST(l_partkey AS STRING) AS charger_id, CAST(min(l_shipdate) AS DATE) AS valid_from,
       CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE CAST(max(l_shipdate) AS DATE) END AS valid_to
FROM lineitem GROUP BY l_suppkey, l_partkey
"""

_TABLES = {"asset": (ASSET, ("supplier", "nation", "lineitem")), "mapping": (MAPPING, ("lineitem",)), "charge_day": (CHARGE_DAY, ("lineitem", "orders")), "charge_raw": (CHARGE_RAW, ("events",)), "station": (STATION, ("supplier", "nation")), "bridge": (BRIDGE, ("supplier",))}


def projection(spark: SparkSession, sf_dir: str, name: str, columns: tuple[str, ...] | None = None, deal: tuple[str, str, int] | None = None) -> DataFrame:
    """columns: what the caller reads of it (None: all). Only these are computed: a struct of all would compute all. deal: a table,
    a column of it by which the SQL groups, and the number of parts into which its rows are dealt by that column beforehand."""
    sql, tables = _TABLES[name]
    args = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    if deal:
        table, key, parts = deal
        args[table] = args[table].repartition(parts, key)
    for t in tables:
        args[t].createOrReplaceTempView(t)
    rows = spark.sql(sql).select(*columns or "*")
    # one generated struct per row: the nested rules are computed once instead of being copied into every later filter and column
    return rows.select(F.inline(F.array(F.struct(*rows.columns)))) if name in ("charge_day", "charge_raw") else rows
