"""Sources and sinks: landing scans, canonical schema, incremental choice of sources, writes, snapshot checks."""

from __future__ import annotations

import csv
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S

# fixed values: canonical field -> other header names it is found under
ALIASES = {
    "order_id": ("交易流水号", "订单编号"), "user_id": ("用户编码", "用户ID"), "station_id": ("充电站ID", "站点ID"), "station_name": ("充电站名称", "站点名称"), "charger_id": ("充电桩编号",),
    "status": ("订单状态",), "charge_method": ("充电方式",), "channel": ("订单渠道",), "source": ("订单来源",), "user_type": ("用户类型",), "end_reason": ("结束原因", "停止原因"),
    "start_time": ("充电开始时间",), "end_time": ("充电结束时间",), "create_time": ("创建时间",), "pay_time": ("支付时间",),
    "kwh": ("交易电量(kWh)", "交易电量"), "meter_kwh": ("抄表电量(kWh)", "抄表电量"), "sharp_kwh": ("尖电量(kWh)",), "peak_kwh": ("峰电量(kWh)",), "flat_kwh": ("平电量(kWh)",), "valley_kwh": ("谷电量(kWh)",), "deep_valley_kwh": ("深谷电量(kWh)",), "low_valley_kwh": ("低谷电量(kWh)",),
    "ef": ("EF", "电费"), "sf": ("SF", "服务费"), "amount": ("交易金额",), "paid_ef": ("A_EF", "实扣电费"), "paid_sf": ("A_SF", "实扣服务费"), "coupon_discount": ("discount", "优惠券金额"), "promotion_discount": ("活动优惠金额",), "other_discount": ("其他优惠金额",),
}
DOUBLES = ("kwh", "meter_kwh", "sharp_kwh", "peak_kwh", "flat_kwh", "valley_kwh", "deep_valley_kwh", "low_valley_kwh", "ef", "sf", "amount", "paid_ef", "paid_sf", "coupon_discount", "promotion_discount", "other_discount")
TIMES = ("create_time", "pay_time", "start_time", "end_time")


def landing_scan(spark: SparkSession, root: str, fmt: str = "parquet", schema: T.StructType | None = None, **options) -> DataFrame:
    """All order files below root, with source_file and source_table (name without ending)."""
    read = lambda kind: spark.read.format(kind).option("recursiveFileLookup", "true").options(**options)
    rows = (read(fmt).schema(schema) if schema else read(fmt)).load(root)
    return tag_source(rows.withColumn("source_file", F.col("_metadata.file_path")), files=read("binaryFile").load(root).select(F.col("_metadata.file_path").alias("source_file")))


def named_by_file(rows: DataFrame, name: Column, file_col: str, files: DataFrame | None = None) -> DataFrame:
    """rows with source_table before their columns. name, of file_col, is made once for each file and joined to its rows, as taking it
    out of the path costs more than reading a row. files: the files by file_col, as listed; without them they are told from the rows."""
    names = (rows if files is None else files).select(file_col).distinct().select(name.alias("source_table"), F.col(file_col).alias("_file"))
    return rows.join(F.broadcast(names), F.col(file_col) == F.col("_file"), "left").select("source_table", *rows.columns)


def tag_source(df: DataFrame, file_col: str = "source_file", files: DataFrame | None = None) -> DataFrame:
    name = F.regexp_extract(F.url_decode(F.col(file_col)), r"([^/]+?)(\.[A-Za-z0-9.]+)?$", 1)
    return named_by_file(df, S.safe_ident(name), file_col, files)


_BAD = "_bad_line"


def csv_headers(spark: SparkSession, paths: list[str] | str, encoding: str = "UTF-8") -> dict[tuple[str, ...], list[str]]:
    """The files below the paths by their header. Of each file the driver reads the first line, no more; empty files have none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path")
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()

    def first_line(path: str) -> str:
        at = jvm.org.apache.hadoop.fs.Path(path)
        stream = at.getFileSystem(conf).open(at)
        try:
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding)).readLine() or ""
        finally:
            stream.close()

    found: dict[tuple[str, ...], list[str]] = {}
    for path in sorted(r["path"] for r in files.collect()):
        if line := first_line(path).removeprefix("\ufeff"):
            found.setdefault(tuple(c.strip() for c in next(csv.reader([line]))), []).append(path)
    return found


def _csv_lines(spark: SparkSession, paths: list[str] | str, encoding: str) -> DataFrame | None:
    """Every line of the files, columns by name, with source_file and whether the line does not fit its file's header."""
    parts = []
    for header, files in csv_headers(spark, paths, encoding).items():
        taken: set[str] = set()
        fields = []
        for k, name in enumerate(header):
            fields.append(f"_again{k}" if name.lower() in taken or not name else name)
            taken.add(name.lower())
        schema = T.StructType([T.StructField(c, T.StringType()) for c in (*fields, _BAD)])
        rows = spark.read.schema(schema).csv(files, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD, multiLine=True, enforceSchema=True, encoding=encoding, escape='"')
        named = [F.col(f"`{c}`") for c in fields if c in header]
        bad = F.col(_BAD).isNotNull() & ~F.col(f"`{fields[0]}`").eqNullSafe("\0")  # the latter holds always: Spark refuses to read the text of bad lines alone
        parts.append(rows.select(*named, bad.alias(_BAD), F.col("_metadata.file_path").alias("_source_file")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def csv_tolerant_scan(spark: SparkSession, paths: list[str] | str, columns: list[str] | None = None, encoding: str = "UTF-8") -> DataFrame:
    """CSV files as text columns, joined by name: each file is read by its own header, what it lacks is null. Of a name that a header
    repeats the first column counts. Values may hold line breaks and doubled quotes. Lines with more or fewer values than the header are dropped,
    whatever columns are selected; ``csv_bad_lines`` counts them. columns: these only, in this order; one that no file has is null."""
    rows = _csv_lines(spark, paths, encoding)
    if rows is None:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns or []]))
    there = {c.lower() for c in rows.columns}
    wanted = columns if columns is not None else [c for c in rows.columns if c not in (_BAD, "_source_file")]
    return rows.where(~F.col(_BAD)).select(*[F.col(f"`{c}`") if c.lower() in there else F.lit(None).cast("string").alias(c) for c in wanted])


def csv_bad_lines(spark: SparkSession, paths: list[str] | str, encoding: str = "UTF-8") -> DataFrame:
    """(source_file, lines, bad_lines) of each file that has lines behind its header."""
    rows = _csv_lines(spark, paths, encoding)
    if rows is None:
        return spark.createDataFrame([], "source_file string, lines long, bad_lines long")
    return rows.groupBy(F.col("_source_file").alias("source_file")).agg(F.count("*").alias("lines"), F.count_if(_BAD).alias("bad_lines"))


def canonicalize(df: DataFrame, aliases: dict | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Canonical fields only: of several columns for one field the first value that is not null; missing ones null."""
    there = set(df.columns)
    out = []
    for field, names in (aliases or ALIASES).items():
        found = [F.col(f"`{n}`").cast("string") for n in (field, *names) if n in there]
        out.append((F.coalesce(*found) if found else F.lit(None).cast("string")).alias(field))
    return df.select(*out, *[c for c in keep if c in there])


def typed_cast(df: DataFrame) -> DataFrame:
    """Text -> numbers and times, what does not parse null (zero dates too); ids and stations normalized."""
    numbers = {c: F.col(c).try_cast("double") for c in DOUBLES if c in df.columns}
    times = {c.replace("_time", "_ts"): F.col(c).try_cast("timestamp_ntz") for c in TIMES if c in df.columns}
    ids = {"user_id": S.normalize_text(F.col("user_id")), "station_id": S.normalize_station_key(F.col("station_id"))}
    return df.withColumns(numbers | times | ids).drop(*TIMES)


def union_years(frames: dict[int, DataFrame]) -> DataFrame:
    out = None
    for year, df in frames.items():
        tagged = df.withColumn("data_year", F.lit(year))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def projected_read(df: DataFrame, columns: list[str]) -> DataFrame:
    return require_columns(df, columns).select(*columns)


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def pick_col(df: DataFrame, candidates: list[str]) -> Column:
    found = [F.col(c) for c in candidates if c in df.columns]
    if not found:
        raise ValueError(f"none of these columns: {', '.join(candidates)}")
    return found[0]


def source_filter(sources: DataFrame, pattern: str = r"^y\d{2}", exclude: tuple[str, ...] = (), like: str | None = None, limit: int | None = None) -> DataFrame:
    """Source names by pattern, without excluded ones and own outputs; with limit the first ones by name."""
    out = sources.where(F.col("source_table").rlike(pattern))
    if like:
        out = out.where(F.col("source_table").like(like))
    if exclude:
        out = out.where(~F.col("source_table").isin(*exclude))
    return out.orderBy("source_table").limit(limit) if limit else out


def sink(df: DataFrame, path: str, mode: str = "append", partition_by: tuple[str, ...] = ()) -> None:
    """Append, or replace: of a partitioned table only the partitions that df holds. Readers merge added columns."""
    writer = df.write.mode(mode).partitionBy(*partition_by)
    if mode == "overwrite" and partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def jdbc_read(spark: SparkSession, url: str, table: str, column: str, low: int, high: int, parts: int, **options) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts, **options).load()


def jdbc_write(df: DataFrame, url: str, table: str, mode: str = "append", **options) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode(mode).save()


def jdbc_read_all(spark: SparkSession, url: str, table: str, column: str, parts: int, **options) -> DataFrame:
    """The table in ``parts`` ranges of a number, date or timestamp column, whose bounds are asked of the table itself; rows without a
    value are in the first range. An empty table is read as one."""
    reader = lambda: spark.read.format("jdbc").options(url=url, **options)
    name = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(column)
    low, high = reader().option("dbtable", f"(SELECT min({name}) AS low, max({name}) AS high FROM {table}) bounds").load().first()
    if low is None:
        return reader().option("dbtable", table).load()
    return reader().options(dbtable=table, partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=parts).load()


def jdbc_write_once(df: DataFrame, url: str, table: str, run: str, overwrite: bool = False, **options) -> bool:
    """Adds df to the table, or puts it in place of its rows, exactly once for each name of a run; False if that run is already there.

    Tasks write into a staging table, with a number for each row, so rows that a repeated task wrote again are told apart. One
    transaction then moves each numbered row once, and enters the run in <table>_runs; before it commits, readers see nothing. The
    database must be able to compare the columns (text as VARCHAR where it cannot compare its long text type: createTableColumnTypes).
    """
    spark = df.sparkSession
    jvm = spark._jvm
    quote = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier
    runs, stage = f"{table}_runs", f"{table}_stage_{uuid.uuid4().hex[:12]}"
    jdbc_write(spark.createDataFrame([], "run string"), url, runs, **options | {"createTableColumnTypes": "run VARCHAR(200)"})
    jdbc_write(df.limit(0), url, table, **options)
    jdbc_write(df.withColumn("_row", F.monotonically_increasing_id()), url, stage, **options)
    columns = ", ".join(quote(c) for c in df.columns)
    link = jvm.java.sql.DriverManager.getConnection(url)
    try:
        link.setAutoCommit(False)
        ask = link.prepareStatement(f"SELECT count(*) FROM {runs} WHERE {quote('run')} = ?")
        ask.setString(1, run)
        found = ask.executeQuery()
        found.next()
        fresh = found.getInt(1) == 0
        found.close()
        if fresh:
            todo = link.createStatement()
            if overwrite:
                todo.executeUpdate(f"DELETE FROM {table}")
            todo.executeUpdate(f"INSERT INTO {table} ({columns}) SELECT {columns} FROM (SELECT DISTINCT * FROM {stage}) once")
            enter = link.prepareStatement(f"INSERT INTO {runs} ({quote('run')}) VALUES (?)")
            enter.setString(1, run)
            enter.executeUpdate()
        link.commit()
        link.createStatement().executeUpdate(f"DROP TABLE {stage}")
        link.commit()
    finally:
        link.rollback()
        link.close()
    return fresh


def export_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(timestampFormat="yyyy-MM-dd HH:mm:ss", timestampNTZFormat="yyyy-MM-dd HH:mm:ss", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path, header=True, encoding="UTF-8", escape='"')


def snapshot_meta(df: DataFrame, weight: str = "raw_orders") -> DataFrame:
    """Rows and original orders (null counts as 1, least 1)."""
    w = F.greatest(F.coalesce(F.col(weight).try_cast("long"), F.lit(1)), F.lit(1)) if weight in df.columns else F.lit(1)
    return df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(w), F.lit(0)).alias("original_orders"))


def validate_snapshot(df: DataFrame, meta: DataFrame, weight: str = "raw_orders") -> DataFrame:
    """The recomputed meta; raises where it differs from the stored one."""
    now = snapshot_meta(df, weight)
    both = now.crossJoin(F.broadcast(meta.select(F.col("n_rows").alias("r"), F.col("original_orders").alias("o"))))
    good = (F.col("n_rows") == F.col("r")) & (F.col("original_orders") == F.col("o"))
    return both.withColumn("n_rows", F.when(good, F.col("n_rows")).otherwise(F.raise_error(F.lit("snapshot differs from its meta")))).select("n_rows", "original_orders")
