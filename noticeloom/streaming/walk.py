"""The walk over listings as a stream: pages come in any order and any number of micro-batches, state says what was seen.

A listing's state holds the addresses that its pages have brought (a map by page whose entries expire), pages that came
before their turn, and a mark: the page whose turn it is and whether the walk has stopped. A page is judged when its turn comes,
so the result does not depend on how pages were dealt out to micro-batches, and a restart from the checkpoint goes on
where the last one ended.
"""

from __future__ import annotations

import contextlib
import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from noticeloom.functions import urls
from noticeloom.operators.flow import PAGE_CAP, PAGE_CAPS

#: What a page's items carry through the stream, and the row that comes out.
ITEM = "ordinal bigint, url string, publish_date date"
PAGE = f"slug string, platform string, page bigint, items array<struct<{ITEM.replace(' ', ':').replace(',:', ',')}>>"
OUT = "slug string, page bigint, n_new bigint, max_year bigint, ordinal bigint, url string, publish_date string"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Walk(StatefulProcessor):
    """One listing's walk; keep_ms: how long an address counts as seen, target_min: the oldest year that is wanted."""

    def __init__(self, target_min: int | None, keep_ms: int, caps: dict[str, int], cap: int):
        self.target_min, self.keep_ms, self.caps, self.cap = target_min, keep_ms, caps, cap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "page bigint", "addresses string", ttlDurationMs=self.keep_ms)
        self.early = handle.getMapState("early", "page bigint", "platform string, items string")
        self.mark = handle.getValueState("mark", "turn bigint, stopped boolean, waiting bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        """Each call of the state is a message to the JVM; so addresses are read once, and only pages that must wait are put down.

        Memory holds a listing's addresses, which its cap of pages bounds, and its pages of this micro-batch.
        """
        turn, stopped, waiting = self.mark.get() if self.mark.exists() else (0, False, 0)
        came: dict[int, tuple[str, str]] = {}
        for batch in rows:
            if not stopped:
                came |= {int(p): (f, i) for p, f, i in zip(batch["page"], batch["platform"], batch["items"]) if p >= turn}
        if stopped or not came:
            return
        seen = {a for _, (told,) in self.seen.iterator() for a in json.loads(told)} if turn else set()
        out: list[tuple] = []
        while not stopped:
            if turn not in came and waiting and self.early.containsKey((turn,)):
                came[turn] = self.early.getValue((turn,))
                self.early.removeKey((turn,))
                waiting -= 1
            if turn not in came:
                break
            platform, items = came.pop(turn)
            told = sorted(json.loads(items), key=lambda x: x["ordinal"])
            fresh = list({x.get("address") or "": x for x in reversed(told)}.items())  # the first item of each address
            fresh = sorted((x for a, x in fresh if a not in seen), key=lambda x: x["ordinal"])
            new = [x.get("address") or "" for x in fresh]
            seen.update(new)
            self.seen.updateValue((turn,), (json.dumps(new),))
            years = [int(x["publish_date"][:4]) for x in told if x.get("publish_date")]
            newest = max(years, default=None)
            out += [(key[0], turn, len(fresh), newest, x["ordinal"], x["url"], x.get("publish_date")) for x in fresh or [{"ordinal": None, "url": None}]]
            old = self.target_min is not None and newest is not None and newest < self.target_min
            turn += 1
            stopped = not fresh or old or turn >= self.caps.get(platform, self.cap)
        if stopped:  # what came behind the end is not needed any more
            self.early.clear()
        else:
            for page, told in came.items():
                waiting += not self.early.containsKey((page,))  # a page that comes again is the same page
                self.early.updateValue((page,), told)
        self.mark.update((turn, stopped, waiting))
        if out:
            yield _frame(out)

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in OUT.split(", ")]
    kinds = {c.split()[0]: "Int64" for c in OUT.split(", ") if c.endswith("bigint")}
    return pd.DataFrame(rows, columns=names).astype(kinds)


@contextlib.contextmanager
def stream_settings(spark: SparkSession):
    """Map state needs RocksDB; batches without data would go on for ever where time counts. The session's own settings come back afterwards."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKS, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def walked_stream(pages: DataFrame, target_min: int | None = None, keep_days: int = 90, caps: dict[str, int] | None = None, cap: int = PAGE_CAP) -> DataFrame:
    """pages (slug, platform, page, items; a stream) to slug, page, n_new, max_year and the new items of every page that the walk reads.

    Pages count from 0. The walk stops after a page without new addresses, one that is wholly older than target_min, or the
    platform's cap; the page that stops it is read, later ones are not. A page without new items gives one row without an
    item. A page waits for those before it. An address counts as seen for keep_days after it came.
    """
    item = F.transform("items", lambda x: F.struct(x["ordinal"].alias("ordinal"), x["url"].alias("url"), x["publish_date"].cast("string").alias("publish_date"), urls.normal(x["url"]).alias("address")))
    rows = pages.select(F.coalesce("slug", F.lit("")).alias("slug"), F.coalesce("platform", F.lit("")).alias("platform"), "page", F.to_json(F.coalesce(item, F.array())).alias("items"))
    walk = Walk(target_min, keep_days * 86_400_000, PAGE_CAPS if caps is None else caps, cap)
    made = rows.groupBy("slug").transformWithStateInPandas(walk, outputStructType=OUT, outputMode="Append", timeMode="ProcessingTime")
    return made.withColumn("publish_date", F.col("publish_date").cast("date"))


def run_walk(spark: SparkSession, incoming: str, out: str, checkpoint: str, files_a_batch: int | None = None, **rules: Any) -> int:
    """Walk through all page files (Parquet, PAGE) in incoming that no earlier run has taken, rows appended to out; micro-batches that ran."""
    stream = spark.readStream.schema(PAGE)
    stream = stream.option("maxFilesPerTrigger", files_a_batch) if files_a_batch else stream
    with stream_settings(spark):
        made = walked_stream(stream.parquet(incoming), **rules).writeStream.format("parquet").option("path", out)
        run = made.option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        run.awaitTermination()
    return sum(p["numInputRows"] > 0 for p in run.recentProgress)


def page_table(spark: SparkSession, out: str) -> DataFrame:
    """slug, page, n_new, max_year of every page that was read."""
    return spark.read.parquet(out).select("slug", "page", "n_new", "max_year").distinct()
