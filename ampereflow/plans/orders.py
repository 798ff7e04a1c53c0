"""Order-level queries and their SQL: scalar rules, cleaning, sessions, stations, features."""

from __future__ import annotations

import tempfile
import uuid
from functools import cached_property

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
from ..sources.fixtures import projection


FIRST = "2000-01-01"  #: the orders of the test tables reach further back than those of the surveyed project


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, which driver and executors share; a local session without one has a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once below the shared folder and read back: several branches read it, and a lost executor costs no recomputation."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def day(spark: SparkSession, sf: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    return projection(spark, sf, "charge_day", columns)


def typed(spark: SparkSession, sf: str) -> DataFrame:
    return L.typed_cast(L.canonicalize(projection(spark, sf, "charge_raw")))


def judged(spark: SparkSession, sf: str) -> DataFrame:
    return C.discard_rules(typed(spark, sf))


def main(spark: SparkSession, sf: str) -> DataFrame:
    return C.derive_order_fields(C.split_main_discard(judged(spark, sf))[0])


def sessions(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_sessions(judged(spark, sf))


def base(spark: SparkSession, sf: str) -> DataFrame:
    return P.order_behavior_base(P.recent_window(P.exclude_category(P.sequenced(day(spark, sf)))), FIRST)


def wide(spark: SparkSession, sf: str, orders: DataFrame | None = None) -> DataFrame:
    return P.user_wide(day(spark, sf) if orders is None else orders, first=FIRST)


def segments(spark: SparkSession, sf: str, orders: DataFrame | None = None) -> DataFrame:
    return P.rfm_segments(wide(spark, sf, orders))


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    return df.select(*[S.round_n(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def stations(spark: SparkSession, sf: str) -> DataFrame:
    return projection(spark, sf, "station")


def valid(spark: SparkSession, sf: str) -> DataFrame:
    return R.valid_orders(P.sequenced(day(spark, sf)))


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return G.user_daily(day(spark, sf, DAYS))


def rolling(spark: SparkSession, sf: str) -> DataFrame:
    return lists(spark, sf)["snapshots"]


DAYS = ("user_id", "start_ts", "station_category", "energy_kwh")  #: what user-days read of an order
LISTED = ("user_id", "start_ts", "station_category", "energy_kwh", "abnormal_reason", "end_reason_class")  #: what windows and lists read of an order

PART = 30_000  #: user-days of which one task makes the windows
PERIOD_PART = 100_000  #: user-days of which one task makes the periods


def parts(df: DataFrame, most: int) -> int:
    """Parts of about most rows, so many that a task holds no more as df grows."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // most))


MAPPED_PART = 250_000  #: line items of which one task makes mappings


def mapping_periods(spark: SparkSession, sf: str) -> DataFrame:
    """In parts that grow in number with the line items, so that neither the mappings nor their chargers are groups of ever larger tasks."""
    n = parts(spark.read.parquet(f"{sf}/lineitem.parquet"), MAPPED_PART)
    return A.mapping_periods(projection(spark, sf, "mapping", deal=("lineitem", "l_partkey", n)), n)


class Lists:
    """Everything the segmentation needs, each made when it is first asked for; what several branches read is written once: the
    orders (of which the caller names the columns, None: all), the user-days and the periods. Snapshots, which have a row for each
    user and window, are not written: they are made from the user-days without a shuffle of their own rows; periods do without them."""

    def __init__(self, spark: SparkSession, sf: str, columns: tuple[str, ...] | None = LISTED) -> None:
        self.spark, self.sf, self.columns = spark, sf, columns

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    @cached_property
    def day(self) -> DataFrame:
        return written(day(self.spark, self.sf, self.columns), "day")

    @cached_property
    def daily(self) -> DataFrame:
        orders = self.day if "day" in self.__dict__ else day(self.spark, self.sf, DAYS)  # nothing else has asked for orders: they are read once
        return written(G.user_daily(orders), "daily")

    @cached_property
    def snapshots(self) -> DataFrame:
        return G.rolling_rfm_snapshots(self.daily, parts=parts(self.daily, PART))

    @cached_property
    def periods(self) -> DataFrame:
        return written(G.window_periods(self.daily, parts=parts(self.daily, PERIOD_PART)), "periods")

    @cached_property
    def states(self) -> DataFrame:
        return G.four_state(G.high_value_trajectory(self.periods), G.last_windows(self.periods))

    @cached_property
    def base(self) -> DataFrame:
        reason = F.when(F.col("abnormal_reason") != "", F.col("abnormal_reason")).otherwise(F.col("end_reason_class"))
        return G.list_base(self.day.withColumn("reason_text", reason))

    @cached_property
    def new(self) -> DataFrame:
        return G.new_users(self.base)

    @cached_property
    def returning(self) -> DataFrame:
        base = self.base  # the orders are written before the user-days, which then read them
        return G.returning_hv_flags(G.returning_users(base), self.periods, self.states)

    @cached_property
    def abnormal(self) -> DataFrame:
        return G.recent_abnormal(self.base)

    @cached_property
    def main(self) -> DataFrame:
        """Where the caller has named columns, those that they do not give are made of nulls: only what hangs on the named ones may be read."""
        lacking = {f.name: F.lit(None).cast(f.dataType) for f in day(self.spark, self.sf).schema if f.name not in self.day.columns}
        return segments(self.spark, self.sf, self.day.withColumns(lacking))


def lists(spark: SparkSession, sf: str, columns: tuple[str, ...] | None = LISTED) -> Lists:
    return Lists(spark, sf, columns)


def codes(spark: SparkSession, sf: str) -> tuple[DataFrame, Lists]:
    """((user_id, segment_code) of final, lists), from the columns and scores that the codes hang on."""
    x = lists(spark, sf, (*LISTED, "is_valid"))
    main = x["main"].select("user_id", "r_score", "f_score", "m_score")
    return G.assign_segments(main, x["states"], x["new"], x["returning"]).select("user_id", "segment_code"), x


def places(spark: SparkSession, sf: str) -> DataFrame:
    """(user_id, top_hour1, station_share1) of final: its users are those of the main table, so no window or list is needed."""
    return lists(spark, sf, ("user_id", "start_ts", "station_category", "station_id", "is_valid"))["main"].select("user_id", "top_hour1", "station_share1")


def final(spark: SparkSession, sf: str, again: bool = False) -> tuple[DataFrame, Lists]:
    """(segments, lists); with again what goes into the segments is written first, as the caller reads it again."""
    x = lists(spark, sf, None)
    for k in ("main", "states", "new", "returning", "abnormal") if again else ("main",):
        setattr(x, k, written(x[k], k))
    found = G.final_segment(x["main"], x["states"], x["new"], x["returning"], x["abnormal"])
    return (written(found, "final") if again else found), x
