"""The store of releases: day partitions, an upsert by address that rewrites only days that change, sinks, migrations."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticeloom.operators.flow import store_order

COLUMNS = ("slug", "ticker", "title", "url", "publish_date", "publish_time")
SCHEMA = "slug string, ticker string, title string, url string, publish_date string, publish_time string"


def read_days(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    """All day files below root/year/, as text, with the file that each row is from. No files give an empty frame."""
    names = columns or COLUMNS
    if not has_files(spark, f"{root}/*/*.csv"):
        return spark.createDataFrame([], f"{SCHEMA}, source_file string").select(*names, "source_file")
    made = spark.read.csv(f"{root}/*/*.csv", schema=SCHEMA, header=True, multiLine=True, escape='"', enforceSchema=False)
    return made.select(*names, F.col("_metadata.file_path").alias("source_file"))


def read_baseline(spark: SparkSession, path: str, required: tuple[str, ...] = ("year", "slug", "ticker", "release_count")) -> DataFrame:
    made = spark.read.csv(path, header=True)
    missing = sorted(set(required) - set(made.columns))
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    return made.select(*required).withColumn("year", F.expr("try_cast(year AS bigint)")).withColumn("release_count", F.expr("try_cast(release_count AS bigint)"))


def _differs(new: str, old: str) -> Column:
    out = F.lit(False)
    for c in COLUMNS:
        out = out | ~F.col(f"{new}.{c}").eqNullSafe(F.col(f"{old}.{c}"))
    return out


def classify(existing: DataFrame, incoming: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """incoming with change: added, updated or same, against the last row of its address in its day.

    existing needs the ordinal that says which of its rows is last.
    """
    last = existing.groupBy("publish_date", "url").agg(F.max_by(F.struct(*COLUMNS), ordinal).alias("old"))
    last = last.select(F.col("publish_date").alias("_d"), F.col("url").alias("_u"), "old")
    new = incoming.select(F.struct(*COLUMNS).alias("new"), *incoming.columns)
    met = new.join(last, (F.col("publish_date") == F.col("_d")) & (F.col("url") == F.col("_u")), "left")
    change = F.when(F.col("old").isNull(), "added").when(_differs("new", "old"), "updated").otherwise("same")
    return met.withColumn("change", change).drop("new", "old", "_d", "_u")


def touched_days(changes: DataFrame) -> DataFrame:
    return changes.filter("change <> 'same'").select("publish_date").distinct()


def marked(existing: DataFrame, incoming: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """The rows of both with new (came in) and change (added, updated or same; null for rows that were there), less those that incoming replaces.

    existing's last row of an address, by ordinal, is the one that incoming rows are held against. Both sides are dealt out
    once, by day and address, so that a day of any size is spread over tasks.
    """
    was = existing.select(*COLUMNS, F.lit(False).alias("new"), F.col(ordinal).alias("place"))
    now = incoming.select(*COLUMNS, F.lit(True).alias("new"), F.lit(None).cast("long").alias("place"))
    address = Window.partitionBy("publish_date", "url")
    last = F.max_by(F.when(~F.col("new"), F.struct(*COLUMNS)), F.when(~F.col("new"), F.col("place"))).over(address)
    rows = was.unionByName(now).withColumns({"old": last, "comes": F.max("new").over(address)})
    rows = rows.filter(F.col("new") | ~F.col("comes")).withColumn("now", F.struct(*COLUMNS))
    change = F.when(~F.col("new"), F.lit(None)).when(F.col("old").isNull(), "added").when(_differs("now", "old"), "updated").otherwise("same")
    return rows.select(*COLUMNS, "new", change.alias("change"))


def merge(existing: DataFrame, incoming: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """The rows of the days that change: existing ones whose address does not come in, and all that come in.

    Rows that come in twice stay twice. Days without a change are not returned, so they are not written. Only days that come
    in are dealt out; both sides meet in one shuffle, whose result serves for the days that change as well.
    """
    dated = incoming.filter(F.col("publish_date").isNotNull())
    asked = dated.select("publish_date").distinct()
    rows = marked(existing.join(asked, "publish_date", "left_semi"), dated, ordinal)
    return rows.join(touched_days(rows), "publish_date", "left_semi").select(*COLUMNS)


def summary(incoming: DataFrame, changes: DataFrame) -> DataFrame:
    """One row: files_written, rows_added, rows_updated, undated."""
    made = changes.agg(
        F.countDistinct(F.when(F.col("change") != "same", F.col("publish_date"))).alias("files_written"),
        F.count_if(F.col("change") == "added").alias("rows_added"),
        F.count_if(F.col("change") == "updated").alias("rows_updated"),
    )
    return made.crossJoin(incoming.agg(F.count_if(F.col("publish_date").isNull()).alias("undated")))  # one row by one row


def write_days(rows: DataFrame, root: str) -> None:
    """Sorted CSV, one folder a day; only the days in rows are overwritten."""
    made = rows.withColumn("day", F.col("publish_date"))
    made = made.repartition("day").sortWithinPartitions("day", *store_order())
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").csv(root, header=True, escape='"', emptyValue="")


def read_day(spark: SparkSession, root: str, day: str) -> DataFrame:
    """The rows of one day's file, as text; no file gives no rows."""
    path = f"{root}/{day[:4]}/{day}.csv"
    if not _files(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.csv(path, schema=SCHEMA, header=True, multiLine=True, escape='"', enforceSchema=False).na.fill("")


def has_files(spark: SparkSession, pattern: str) -> bool:
    return bool(_files(spark, pattern))


def _files(spark: SparkSession, pattern: str) -> list:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return list(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or [])


def write_day_files(rows: DataFrame, root: str) -> int:
    """Sorted CSV, a file root/year/day.csv for each day in rows, in place of the one that was there; how many were written.

    Each day is written by one task into a staging folder; then each file takes its place by one rename over the old one, so
    that a crash leaves every day as it was or as it becomes, none without a file. daystore.DayStore commits all days at once.
    """
    spark, staged = rows.sparkSession, f"{root}/_staged-{uuid.uuid4().hex}"
    made = rows.withColumn("_year", F.date_format("publish_date", "yyyy")).withColumn("_day", F.col("publish_date").cast("string"))
    made = made.select(*COLUMNS, "_year", "_day").repartition("_year", "_day").sortWithinPartitions("_year", "_day", *store_order())
    made.write.partitionBy("_year", "_day").csv(staged, header=True, escape='"', emptyValue="")
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    fs = hadoop.Path(root).getFileSystem(conf)
    context = hadoop.FileContext.getFileContext(fs.getUri(), conf)
    over = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    over[0] = hadoop.Options.Rename.OVERWRITE
    written = 0
    for status in _files(spark, f"{staged}/*/*/part-*"):
        folder = status.getPath().getParent()
        day, year = folder.getName().split("=")[1], folder.getParent().getName().split("=")[1]
        target = fs.makeQualified(hadoop.Path(f"{root}/{year}/{day}.csv"))
        fs.mkdirs(target.getParent())
        context.rename(status.getPath(), target, over)
        written += 1
    fs.delete(hadoop.Path(staged), True)
    return written


def upsert_row(existing: DataFrame, row: DataFrame) -> tuple[DataFrame, str]:
    """A day's rows with this one in place of its address's, in the store's order, and what that did: Created, Added or Updated."""
    address = row.select("url")
    kept = existing.select(*COLUMNS).join(address, "url", "left_anti")
    n, left = existing.count(), kept.count()
    action = "Updated" if left < n else "Added" if n else "Created"
    return kept.select(*COLUMNS).unionByName(row.select(*COLUMNS)).orderBy(*store_order()), action


def split_undated(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that have a day to be stored under, and those that have none."""
    return rows.filter(F.col("publish_date").isNotNull()), rows.filter(F.col("publish_date").isNull())


def undated_counts(rows: DataFrame, *by: str) -> DataFrame:
    """By key, how many rows each side of split_undated has."""
    return rows.groupBy(*by).agg(F.count_if(F.col("publish_date").isNull()).alias("undated"), F.count_if(F.col("publish_date").isNotNull()).alias("dated"))


def read_day_folders(spark: SparkSession, root: str) -> DataFrame:
    """What write_days wrote, with the day as partition column."""
    return spark.read.csv(root, schema=f"{SCHEMA}, day date", header=True, multiLine=True, escape='"')


def scratch_path(spark: SparkSession) -> str:
    """A new folder below the one that the cluster shares; a local session without one uses /tmp/checkpoints."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = "/tmp/checkpoints"
    made = f"{root.rstrip('/')}/store-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, made)
    return made


def keeper(spark: SparkSession, root: str | None = None) -> Callable[[DataFrame, str], DataFrame]:
    """keep(df, name): writes df below root (a new scratch folder without one) and gives the rows read back; it cuts lineage."""
    place = root or scratch_path(spark)

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{place}/{name}")
        return spark.read.schema(df.schema).parquet(f"{place}/{name}")

    return keep


def _delete(spark: SparkSession, path: str) -> None:
    """What a scratch folder holds may be read as long as the program runs."""
    with contextlib.suppress(Exception):  # the session may be gone by now
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def as_json(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(*keep, F.to_json(F.struct(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in COLUMNS))).alias("json"))


def rename_column(rows: DataFrame, old: str = "publish_datetime", new: str = "publish_date") -> DataFrame:
    """The column renamed, and whether its value is a plain date."""
    made = rows.withColumnRenamed(old, new) if old in rows.columns else rows
    return made.withColumn("is_date", F.coalesce(F.col(new).cast("string").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False)))


def add_column(rows: DataFrame, name: str = "publish_time", default: str = "") -> DataFrame:
    return rows if name in rows.columns else rows.withColumn(name, F.lit(default))
