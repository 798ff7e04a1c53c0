"""File-stream forms: incremental cleaning, hourly orders, user days. The rules are the batch functions'."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import values as V
from ..operators import cleaning
from ..sources import landing


def order_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def incremental_clean_stream(raw: DataFrame, out: str, checkpoint: str, rules: V.CleanRules = V.CleanRules()):
    """New landing files -> main, discarded and abnormal orders below ``out``. A batch writes under its own number and replaces
    what an earlier try of the same batch left, so a restart neither loses nor repeats rows."""
    def write(batch: DataFrame, number: int) -> None:
        judged = cleaning.discard_rules(landing.typed_cast(landing.canonicalize(batch)), rules)
        judged = judged.persist()
        main, discarded = cleaning.split_main_discard(judged)
        main = cleaning.derive_order_fields(main)
        for name, df in (("main", main), ("discarded", discarded), ("abnormal", cleaning.abnormal_orders(main))):
            df.write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")
        judged.unpersist()

    return raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hourly_orders_stream(orders: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Orders per hour of the start; rows later than the watermark are dropped."""
    return orders.withWatermark("start_ts", delay).groupBy(F.window("start_ts", "1 hour")).agg(F.count("*").alias("orders")).select(F.col("window.start").alias("hour_start"), "orders")


def user_daily_stream(orders: DataFrame, delay: str = "2 days") -> DataFrame:
    """The user-day table as orders arrive, for update mode."""
    rows = orders.withWatermark("start_ts", delay).groupBy(F.window("start_ts", "1 day"), "user_id").agg(F.count("*").alias("orders"), F.sum(F.col("energy_kwh").cast("decimal(18,3)")).alias("kwh"), F.max("start_ts").alias("last_ts"))
    return rows.select("user_id", F.to_date("window.start").alias("order_date"), "orders", "kwh", "last_ts")


def run_to_table(df: DataFrame, name: str, checkpoint: str, mode: str = "complete") -> DataFrame:
    """Runs a streaming aggregate over what is there and returns its result; for bounded results."""
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.table(name)
