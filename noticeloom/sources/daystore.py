"""The store of releases as a Spark data source over day files, with whole commits.

A day's rows lie in one or more CSV files; a manifest says which files make up the store. A commit first writes new files
under names of its own, then the next manifest beside them, and last gives that manifest its number by one rename that
fails if the number is taken. A reader follows the last whole manifest; so it sees a commit whole or not at all, a crash
leaves the store as it was, and of two writers that started from the same manifest one gets an error.

The reader takes filters on day and drops files before any is opened; small files share a task. A folder without manifests is read
in the plain layout root/year/day.csv; there only the years and days that a filter leaves are listed.
"""

from __future__ import annotations

import datetime
import json
import posixpath
import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from noticeloom.operators.flow import store_order
from noticeloom.sources.store import COLUMNS, SCHEMA, keeper, marked, scratch_path

FORMAT = "daystore"
MANIFESTS, FILES = "_manifests", "_files"
FIRST, LAST = datetime.date.min, datetime.date.max
#: A task reads files up to a 64th of all, but so many bytes at least and at most; each file counts for OPEN bytes more.
SHARE, SMALLEST, LARGEST, OPEN = 64, 2**18, 2**25, 2**14
#: Files of a day in order, each with its size.
Days = dict[str, list[tuple[str, int]]]


class ConcurrentWriteError(RuntimeError):
    """Another writer has committed since this one read the store."""


def whole_manifest(text: str) -> Days | None:
    """Files by day, or None if the manifest is cut short."""
    lines = text.split("\n")
    try:
        told = [json.loads(x) for x in lines if x]
    except ValueError:
        return None
    if not told or told[-1].get("end") != len(told) - 1:
        return None
    return {x["day"]: [tuple(f) for f in x["files"]] for x in told[:-1]}


def manifest_text(days: Days) -> str:
    rows = [json.dumps({"day": d, "files": files}) for d, files in sorted(days.items())]
    return "\n".join([*rows, json.dumps({"end": len(rows)})]) + "\n"


def _number(name: str) -> int | None:
    return int(name) if name.isdigit() else None


class _Folder:
    """A folder on any file system that Arrow knows, for the data source's own processes."""

    def __init__(self, root: str):
        from pyarrow import fs

        self.fs, self.root = fs.FileSystem.from_uri(root) if ":/" in root else (fs.LocalFileSystem(), root)

    def names(self, *parts: str) -> list[tuple[str, int]]:
        """Names and sizes in a folder; none where there is no folder."""
        from pyarrow import fs

        place = posixpath.join(self.root, *parts)
        return sorted((x.base_name, x.size or 0) for x in self.fs.get_file_info(fs.FileSelector(place, allow_not_found=True)))

    def there(self, paths: list[str]) -> list[tuple[str, int]]:
        infos = self.fs.get_file_info([posixpath.join(self.root, p) for p in paths])
        return [(p, x.size) for p, x in zip(paths, infos) if x.is_file]

    def text(self, path: str) -> str:
        with self.fs.open_input_stream(posixpath.join(self.root, path)) as f:
            return f.read().decode()

    def manifest(self, version: int | None) -> Days | None:
        """Of the version, or of the last whole one; None where there is no manifest at all."""
        numbers = sorted((n for x, _ in self.names(MANIFESTS) if (n := _number(x)) is not None and (version is None or n == version)), reverse=True)
        for n in numbers:
            if (days := whole_manifest(self.text(f"{MANIFESTS}/{n:012d}"))) is not None:
                return days
        return {} if numbers or version == 0 else None


class DayFiles(InputPartition):
    """path, day and place among the day's files of each file."""

    def __init__(self, files: list[tuple[str, str, int]]):
        self.files = files


class DayReader(DataSourceReader):
    def __init__(self, root: str, version: int | None):
        self.root, self.version = root, version
        self.low, self.high, self.only = FIRST, LAST, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Comparisons of day with dates decide which files are read at all; Spark evaluates the rest."""
        for f in filters:
            if getattr(f, "attribute", None) != ("day",) or not self._take(f):
                yield f

    def _take(self, f: Filter) -> bool:
        one = datetime.timedelta(days=1)
        values = list(getattr(f, "value", ())) if isinstance(f, In) else [getattr(f, "value", None)]
        if not all(isinstance(x, datetime.date) for x in values if x is not None) or (not isinstance(f, In) and values == [None]):
            return False
        if isinstance(f, In | EqualTo):
            self.only = {x for x in values if x is not None} if self.only is None else self.only & {*values}
        elif isinstance(f, GreaterThan) and values[0] < LAST:
            self.low = max(self.low, values[0] + one)
        elif isinstance(f, GreaterThanOrEqual):
            self.low = max(self.low, values[0])
        elif isinstance(f, LessThan) and values[0] > FIRST:
            self.high = min(self.high, values[0] - one)
        elif isinstance(f, LessThanOrEqual):
            self.high = min(self.high, values[0])
        else:
            return False
        return True

    def _wanted(self, day: str) -> bool:
        try:
            d = datetime.date.fromisoformat(day)
        except ValueError:
            return False
        return self.low <= d <= self.high and (self.only is None or d in self.only)

    def partitions(self) -> list[InputPartition]:
        folder = _Folder(self.root)
        days = folder.manifest(self.version)
        if days is None:
            days = self._plain(folder)
        found = [(path, day, i, size + OPEN) for day, files in sorted(days.items()) if self._wanted(day) for i, (path, size) in enumerate(files)]
        most = min(max(sum(f[3] for f in found) // SHARE, SMALLEST), LARGEST)
        parts, held = [[]], 0
        for *file, size in found:
            if parts[-1] and held + size > most:
                parts.append([])
                held = 0
            parts[-1].append(tuple(file))
            held += size
        return [DayFiles(p) for p in parts]

    def _plain(self, folder: _Folder) -> Days:
        """root/year/day.csv; single days are looked up, without one the years in range are listed."""
        if self.only is not None:
            asked = {f"{d.year:04d}/{d}.csv": str(d) for d in self.only if self.low <= d <= self.high}
            return {asked[p]: [(p, size)] for p, size in folder.there(sorted(asked))}
        years = [y for y, _ in folder.names() if y.isdigit() and self.low.year <= int(y) <= self.high.year]
        return {name.removesuffix(".csv"): [(f"{y}/{name}", size)] for y in years for name, size in folder.names(y) if name.endswith(".csv")}

    def read(self, part: DayFiles) -> Iterator[pa.RecordBatch]:
        folder = _Folder(self.root)
        for path, day, place in part.files:
            yield from self._rows(folder, path, datetime.date.fromisoformat(day), place)

    def _rows(self, folder: _Folder, path: str, day: datetime.date, place: int) -> Iterator[pa.RecordBatch]:
        from pyarrow import csv

        names = [*COLUMNS, "source_file", "day", "ordinal"]
        full, done = posixpath.join(folder.root, path), 0
        with folder.fs.open_input_stream(full) as f:
            if not f.read(1):
                return
        kinds = csv.ConvertOptions(column_types=dict.fromkeys(COLUMNS, pa.string()), include_columns=[*COLUMNS], include_missing_columns=True, strings_can_be_null=False)
        with folder.fs.open_input_stream(full) as f, csv.open_csv(f, parse_options=csv.ParseOptions(newlines_in_values=True), convert_options=kinds) as batches:
            for batch in batches:
                n = batch.num_rows
                if n:
                    at = pa.array(range((place << 40) + done, (place << 40) + done + n), pa.int64())
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([path] * n), pa.array([day] * n, pa.date32()), at], names)
                done += n


class DayStoreSource(DataSource):
    """format("daystore"): path, and version to stay with one manifest. Columns missing in a file are null."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return f"{SCHEMA}, source_file string, day date, ordinal bigint"

    def reader(self, schema) -> DataSourceReader:
        version = self.options.get("version")
        return DayReader(self.options["path"], int(version) if version is not None else None)


class DayStore:
    """A store at root: read, upsert, and the manifests behind them. Only names of files and days pass through the driver."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        spark.dataSource.register(DayStoreSource)
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join(parts))

    def _list(self, pattern: str) -> list:
        return list(self._fs.globStatus(self._path(self.root, pattern)) or [])

    def _text(self, path) -> str:
        stream = self._fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def current(self) -> tuple[int, Days]:
        """Number and content of the last whole manifest; 0 and nothing for a new store."""
        numbers = sorted((n for s in self._list(f"{MANIFESTS}/*") if (n := _number(s.getPath().getName())) is not None), reverse=True)
        for n in numbers:
            if (days := whole_manifest(self._text(self._path(self.root, MANIFESTS, f"{n:012d}")))) is not None:
                return n, days
        return 0, {}

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the last manifest, or of a version: the store's columns, source_file, day, and ordinal (the row's place in its day)."""
        reader = self.spark.read.format(FORMAT).option("path", self.root)
        return (reader if version is None else reader.option("version", version)).load()

    def upsert(self, incoming: DataFrame, dry_run: bool = False) -> Row:
        """Merge incoming (the store's columns, publish_date a date) and commit the days that change; files_written, rows_added, rows_updated, undated.

        Only days that come in are read. A day is written if one of its rows is added or differs; undated rows are counted.
        """
        version, days = self.current()
        keep = keeper(self.spark, scratch_path(self.spark))
        texts = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in COLUMNS if c != "publish_date"}  # a file does not tell null from empty
        incoming = keep(incoming.select(*(texts.get(c, F.col(c).cast("date")).alias(c) for c in COLUMNS)), "incoming")
        undated = incoming.filter("publish_date is null").count()
        dated = incoming.filter("publish_date is not null")
        asked = [r[0] for r in dated.select("publish_date").distinct().collect()]  # one a day
        there = self.read(version).filter(F.col("day").isin(asked)) if asked and days else self.read(version).limit(0)
        there = there.select(*(F.col("day").alias(c) if c == "publish_date" else c for c in COLUMNS), "ordinal")
        rows = keep(marked(there, dated), "marked")
        by_day = rows.groupBy("publish_date").agg(F.count_if(F.col("change") == "added").alias("added"), F.count_if(F.col("change") == "updated").alias("updated")).filter("added + updated > 0").collect()
        if by_day and not dry_run:
            changed = [r["publish_date"] for r in by_day]
            self.commit(self.stage(rows.filter(F.col("publish_date").isin(changed))), version)
        return Row(files_written=len(by_day), rows_added=sum(r["added"] for r in by_day), rows_updated=sum(r["updated"] for r in by_day), undated=undated)

    def stage(self, rows: DataFrame) -> Days:
        """Write rows' days, sorted, to files that no manifest names yet; the files by day.

        Rows are dealt out by range of day and the store's order, so that a large day is written by several tasks, a file each.
        """
        place = f"{FILES}/{uuid.uuid4().hex}"
        made = rows.select(*COLUMNS, F.col("publish_date").alias("day"))
        order = store_order()
        made.repartitionByRange("day", *order).sortWithinPartitions("day", *order).write.partitionBy("day").csv(f"{self.root}/{place}", header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        files: Days = {}
        for status in self._list(f"{place}/day=*/part-*"):
            folder = status.getPath().getParent().getName()
            files.setdefault(folder.removeprefix("day="), []).append((f"{place}/{folder}/{status.getPath().getName()}", status.getLen()))
        return {day: sorted(names) for day, names in files.items()}

    def commit(self, files: Days, version: int, removed: Iterable[str] = ()) -> int:
        """The next manifest: the version's days, with these files instead of theirs, less the removed ones; its number."""
        now, days = self.current()
        if now != version:
            raise ConcurrentWriteError(f"{self.root} is at {now}, this writer began at {version}")
        days = {d: f for d, f in (days | files).items() if d not in set(removed)}
        draft = self._path(self.root, MANIFESTS, f".{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(manifest_text(days).encode()))
        finally:
            out.close()
        self._publish(draft, self._path(self.root, MANIFESTS, f"{version + 1:012d}"))
        return version + 1

    def _publish(self, draft, target) -> None:
        """One rename that fails if the target is there."""
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        try:
            context.rename(self._fs.makeQualified(draft), self._fs.makeQualified(target), options)
        except Exception as error:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in str(error):
                raise ConcurrentWriteError(f"{target} was written by another writer") from error
            raise

    def changed_days(self, since: int, until: int | None = None) -> list[str]:
        """The days whose files differ between two versions."""
        a, b = ({} if n == 0 else whole_manifest(self._text(self._path(self.root, MANIFESTS, f"{n:012d}"))) for n in (since, self.current()[0] if until is None else until))
        return sorted(d for d in a.keys() | b.keys() if a.get(d) != b.get(d))

    def counts(self) -> DataFrame:
        """year, slug, ticker, release_count of the store, kept up to date by what changed.

        The counts of the last call lie beside the store with the version that they are of. The rows of the days that differ
        since are added as they are now and taken off as they were then; no other day is read.
        """
        version = self.current()[0]
        done = sorted(n for s in self._list("_counts/*/_SUCCESS") if (n := _number(s.getPath().getParent().getName())) is not None and n <= version)
        since = done[-1] if done else 0
        kind = "year bigint, slug string, ticker string, release_count bigint"
        place = f"{self.root}/_counts/{version:012d}"
        if since < version:
            days = [F.lit(d).cast("date") for d in self.changed_days(since, version)]
            parts = [self.spark.read.schema(kind).parquet(f"{self.root}/_counts/{since:012d}")] if since else []
            for n, sign in ((since, -1), (version, 1)):
                if n and days:
                    rows = self.read(n).filter(F.col("day").isin(*days))
                    parts.append(rows.groupBy(F.year("day").cast("long").alias("year"), "slug", "ticker").agg((sign * F.count("*")).alias("release_count")))
            made = reduce(DataFrame.unionByName, parts).groupBy("year", "slug", "ticker").agg(F.sum("release_count").alias("release_count"))
            made.filter("release_count <> 0").write.mode("overwrite").parquet(place)
        return self.spark.read.schema(kind).parquet(place) if version else self.spark.createDataFrame([], kind)

    def vacuum(self, keep: int = 2) -> int:
        """Delete manifests before the last ones kept, and files that none of the kept ones names; how many files went. No writer may be at work."""
        numbers = sorted(n for s in self._list(f"{MANIFESTS}/*") if (n := _number(s.getPath().getName())) is not None)
        for n in numbers[:-keep]:
            self._fs.delete(self._path(self.root, MANIFESTS, f"{n:012d}"), False)
        named = set()
        for n in numbers[-keep:]:
            named |= {f for files in (whole_manifest(self._text(self._path(self.root, MANIFESTS, f"{n:012d}"))) or {}).values() for f, _ in files}
        gone = 0
        for status in self._list(f"{FILES}/*/day=*/part-*"):
            path = status.getPath()
            name = "/".join([FILES, path.getParent().getParent().getName(), path.getParent().getName(), path.getName()])
            if name not in named:
                gone += bool(self._fs.delete(path, False))
        return gone
