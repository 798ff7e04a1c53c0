"""Asset tables: stations judged, retired ones left out, years of service; which station a charger belonged to and for how long."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import values as V
from ..functions import scalars as S


def _degrees(text: Column, most: int) -> Column:
    value = text.try_cast("double")
    return F.when(F.abs(value) <= most, value)


def judge_assets(station: DataFrame) -> DataFrame:
    """One row per asset row: key, type, category, place, status, coordinates, since with its year and month, and outcome.

    outcome is the first that holds of retired, no key, no type, bad place (a coordinate that is given but cannot be one), kept. Stations
    not yet in service or out of order are kept. Expects station_id, station_type, place, status, longitude, latitude, since as text;
    nulls anywhere and repeated rows are judged like any other.
    """
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    rows = station.select(
        S.normalize_station_key(F.col("station_id")).alias("station_key"), S.normalize_station_type(F.col("station_type")).alias("station_type"),
        S.station_type_to_category(F.col("station_type")).alias("category"), S.normalize_category(F.col("place")).alias("place"),
        F.coalesce(text("status"), F.lit(V.UNKNOWN)).alias("status"), text("longitude").alias("_lon"), text("latitude").alias("_lat"), text("since").try_cast("date").alias("since"),
    )
    rows = rows.withColumns({"longitude": _degrees(F.col("_lon"), 180), "latitude": _degrees(F.col("_lat"), 90)})
    wrong = (F.col("_lon").isNotNull() & F.col("longitude").isNull()) | (F.col("_lat").isNotNull() & F.col("latitude").isNull())
    outcome = S.chain([(F.col("status") == V.RETIRED, "retired"), (F.col("station_key").isNull(), "no key"), (F.col("station_type").isNull(), "no type"), (wrong, "bad place")], "kept")
    return rows.withColumns({"since_year": F.year("since"), "since_month": S.year_month(F.col("since")), "outcome": outcome}).drop("_lon", "_lat")


def split_assets(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept assets, rows for the table of problems); retired stations are in neither."""
    return judged.where("outcome = 'kept'").drop("outcome"), judged.where("outcome NOT IN ('kept', 'retired')")


def asset_log(judged: DataFrame) -> DataFrame:
    return judged.groupBy("outcome").agg(F.count("*").alias("assets"), F.count("since").alias("dated"))


def assets_by_year(kept: DataFrame) -> DataFrame:
    """Stations by first year of service, category and status."""
    return kept.groupBy("since_year", "category", "status").agg(F.count_distinct("station_key").alias("stations"))


def mapping_periods(mapping: DataFrame, parts: int | None = None) -> DataFrame:
    """Mappings of chargers to stations with the months that they last and whether they are their charger's latest (by start, end,
    then station). The latest one is an aggregate that is joined back, so a charger with very many rows is not sorted by one task.
    An open end lasts until the latest end of the table; rows without a charger or station are left out; repeated rows are one.
    With parts the rows are dealt by charger into so many parts, in which all of this is done: what a task holds stays the same as the
    table grows, if parts grows with it."""
    rows = mapping.select(S.normalize_station_key(F.col("station_id")).alias("station_key"), F.nullif(F.trim("charger_id"), F.lit("")).alias("charger_id"), F.col("valid_from").cast("date").alias("valid_from"), F.col("valid_to").cast("date").alias("valid_to"))
    rows = rows.where("station_key IS NOT NULL AND charger_id IS NOT NULL")
    last = rows.agg(F.max("valid_to").alias("_last"))
    rows = (rows.repartition(parts, "charger_id") if parts else rows).distinct()
    rows = rows.crossJoin(F.broadcast(last))
    rows = rows.withColumn("_at", F.struct("valid_from", F.coalesce("valid_to", "_last").alias("to"), "station_key"))
    latest = rows.groupBy("charger_id").agg(F.max("_at").alias("_latest"), F.count("*").alias("mappings"))
    to = F.col("_at.to")
    months = (F.year(to) - F.year("valid_from")) * 12 + F.month(to) - F.month("valid_from")
    return rows.join(latest, "charger_id").select("charger_id", "station_key", "valid_from", "valid_to", months.alias("months"), (F.col("_at") == F.col("_latest")).alias("is_latest"), "mappings")
