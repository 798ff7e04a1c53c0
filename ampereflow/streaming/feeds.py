"""Tables that file streams keep current, batch by batch: restart sessions of touched users, and sums per user-day or hour.

Every batch writes under its own number and replaces only the partitions it touches, all made anew from what is stored, so that a
batch that is run again (after a lost driver, say) leaves the same tables. No state is held between batches but these tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import values as V
from ..operators import cleaning
from ..operators.features import exclude_category
from ..sources import landing

BUCKETS = 64


def stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at path; empty, with this schema, where none is yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def replace(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Writes df over the partitions that it has rows of; the others stay as they are."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


# ---- sessions
def add_to_sessions(main: DataFrame, out: str, number: int, rules: V.CleanRules = V.CleanRules(), buckets: int = BUCKETS) -> list[int]:
    """Takes main orders of batch ``number`` into the tables orders and sessions below out; returns the buckets that it rewrote.

    Orders are kept by bucket of the user and batch. The sessions of users with new orders are made anew from all their orders;
    those of other users in the same buckets are carried over; other buckets are neither read nor written. Orders without a user
    are sessions of their own.
    """
    spark = main.sparkSession
    bucket = F.pmod(F.xxhash64(F.coalesce("user_id", "order_id")), F.lit(buckets)).cast("int")
    replace(main.withColumns({"bucket": bucket, "batch": F.lit(number)}).repartition("bucket"), f"{out}/orders", ["bucket", "batch"])
    shape = T.StructType([*main.schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("batch", T.IntegerType())])
    orders = stored(spark, f"{out}/orders", shape)
    new = orders.where(F.col("batch") == number)
    touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())
    if not touched:
        return []
    here, users = F.col("bucket").isin(touched), new.where("user_id IS NOT NULL").select("user_id").distinct()
    again = orders.where(here).join(users, "user_id", "left_semi").unionByName(new.where("user_id IS NULL"))
    made = cleaning.merge_restart_orders(cleaning.restart_sessions(again.drop("bucket", "batch"), rules)).drop("session_no")
    made = made.withColumn("bucket", bucket)
    lone = new.where("user_id IS NULL").select("order_id")
    old = stored(spark, f"{out}/sessions", made.schema).where(here).join(users, "user_id", "left_anti").join(lone, "order_id", "left_anti")
    staged = f"{out}/_staged/batch={number}"
    old.unionByName(made).repartition("bucket").write.mode("overwrite").parquet(staged)  # a table that is read cannot be written
    replace(spark.read.schema(made.schema).parquet(staged), f"{out}/sessions", ["bucket"])
    return touched


def session_feed(raw: DataFrame, out: str, checkpoint: str, rules: V.CleanRules = V.CleanRules(), buckets: int = BUCKETS):
    """New landing files -> discarded orders by batch, main orders and restart sessions of the touched users."""
    def write(batch: DataFrame, number: int) -> None:
        judged = cleaning.discard_rules(landing.typed_cast(landing.canonicalize(batch)), rules)
        main, discarded = cleaning.split_main_discard(judged)
        discarded.write.mode("overwrite").parquet(f"{out}/discarded/batch={number}")
        add_to_sessions(cleaning.derive_order_fields(main), out, number, rules, buckets)

    return raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


# ---- sums by unit of time
LOG = "batch int, rows long, late long, latest timestamp, watermark timestamp"


def add_to_sums(rows: DataFrame, out: str, number: int, unit: str, keys: Sequence[str], sums: dict[str, tuple[Column, str]], delay: str | None, time: str = "start_ts", span: str = "day") -> dict:
    """Takes the rows of batch ``number`` into the table sums below out, by unit ("hour", "day") and keys; returns its log entry.

    sums: name -> (aggregate over rows, aggregate that joins parts of it: "sum", "max" or "min"). Each batch leaves its parts by
    ``span`` (day, or month where batches reach far back) and batch; the spans it touches are then summed anew from all parts.

    A row is late, and left out, if its unit ends no later than the latest time of earlier batches less ``delay`` (None: no row is
    late): the rule of a streaming watermark, but every late row is counted, as it is read, in the log.
    """
    spark = rows.sparkSession
    before = stored(spark, f"{out}/log", T.StructType.fromDDL(LOG)).where(F.col("batch") < number).agg(F.max("latest").alias("t")).first()["t"]
    at = F.date_trunc(unit, F.col(time))
    mark = None if before is None or delay is None else spark.range(1).select((F.lit(before) - F.expr(f"INTERVAL {delay}")).alias("t")).first()["t"]
    late = F.lit(False) if mark is None else at + F.expr(f"INTERVAL 1 {unit}") <= F.lit(mark)
    seen, rows = Observation(f"rows-{number}"), rows.where(F.col(time).isNotNull())
    counts = {"rows": 0, "late": 0, "latest": None}
    if some := not rows.isEmpty():  # nothing is observed where the optimizer knows that there are no rows
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(late).alias("late"), F.max(time).alias("latest"))
    parts = rows.where(~late).groupBy(at.alias(unit), *keys).agg(*[part.alias(n) for n, (part, _) in sums.items()])
    parts = parts.withColumns({"on": F.to_date(F.date_trunc(span, unit)), "batch": F.lit(number)})
    replace(parts.repartition("on"), f"{out}/parts", ["on", "batch"])
    every = stored(spark, f"{out}/parts", parts.schema)
    days = [r["on"] for r in every.where(F.col("batch") == number).select("on").distinct().collect()]
    if days:
        joined = every.where(F.col("on").isin(days)).groupBy("on", unit, *keys).agg(*[getattr(F, how)(n).cast(parts.schema[n].dataType).alias(n) for n, (_, how) in sums.items()])
        replace(joined.repartition("on"), f"{out}/sums", ["on"])
    entry = {"batch": number, **(seen.get if some else counts), "watermark": mark}
    spark.createDataFrame([tuple(entry[c] for c in ("rows", "late", "latest", "watermark"))], LOG.partition(", ")[2]).coalesce(1).write.mode("overwrite").parquet(f"{out}/log/batch={number}")
    return entry


def sums_feed(rows: DataFrame, out: str, checkpoint: str, unit: str, keys: Sequence[str], sums: dict[str, tuple[Column, str]], delay: str | None = None, time: str = "start_ts", span: str = "day"):
    def write(batch: DataFrame, number: int) -> None:
        add_to_sums(batch, out, number, unit, keys, sums, delay, time, span)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hourly_feed(orders: DataFrame, out: str, checkpoint: str, delay: str | None = "2 hours", span: str = "day"):
    """Orders per hour of the start, in the table sums below out."""
    return sums_feed(orders, out, checkpoint, "hour", (), {"orders": (F.count("*"), "sum")}, delay, span=span)


def user_day_feed(orders: DataFrame, out: str, checkpoint: str, delay: str | None = None, span: str = "day"):
    """The user-day table (operators.rolling.user_daily) as orders arrive; ``user_days`` reads it."""
    rows = exclude_category(orders).where(F.trim(F.coalesce("user_id", F.lit(""))) != "")
    sums = {"orders": (F.count("*"), "sum"), "kwh": (F.sum(F.coalesce("energy_kwh", F.lit(0.0)).cast("decimal(18,3)")), "sum"), "last_ts": (F.max("start_ts"), "max")}
    return sums_feed(rows, out, checkpoint, "day", ("user_id",), sums, delay, span=span)


def user_days(spark: SparkSession, out: str) -> DataFrame:
    """What user_day_feed has written, with the columns of operators.rolling.user_daily, for the rolling windows."""
    return spark.read.parquet(f"{out}/sums").select("user_id", F.to_date("day").alias("order_date"), "orders", "kwh", "last_ts")


def late_rows(spark: SparkSession, out: str) -> DataFrame:
    """(batch, rows, late, latest, watermark) of each batch."""
    return stored(spark, f"{out}/log", T.StructType.fromDDL(LOG))
