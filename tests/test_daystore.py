"""The day store: whole commits, pruned reads, and the upsert cases, against plain rules in Python."""

import csv
import datetime
import random
from pathlib import Path

import pytest
from noticeloom.sources import daystore
from noticeloom.sources.daystore import ConcurrentWriteError, DayStore
from noticeloom.sources.store import COLUMNS
from pyspark.sql import functions as F

ROWS = "slug string, ticker string, title string, url string, publish_date date, publish_time string"
D1, D2, D3 = (datetime.date(2026, 1, n) for n in (5, 6, 7))


def frame(spark, *rows):
    return spark.createDataFrame([("s", t, f"{url} {title}", url, day, time) for url, title, day, t, time in rows], ROWS)


def row(url, title="a", day=D1, ticker="S", time=""):
    return (url, title, day, ticker, time)


def held(store, version=None):
    return sorted((r["url"], r["title"], r["day"], r["ticker"], r["publish_time"]) for r in store.read(version).collect())


def told(*rows):
    return sorted((url, f"{url} {title}", day, t or "", time) for url, title, day, t, time in rows)


def test_upsert_cases(spark, tmp_path):
    store = DayStore(spark, f"file://{tmp_path}/store")
    assert store.current() == (0, {}) and store.read().count() == 0
    steps = [
        ([row("u1")], (1, 1, 0, 0), [row("u1")]),
        ([row("u1")], (0, 0, 0, 0), [row("u1")]),
        ([row("u1", "b")], (1, 0, 1, 0), [row("u1", "b")]),
        ([row("u2"), row("u2")], (1, 2, 0, 0), [row("u1", "b"), row("u2"), row("u2")]),
        ([row("u1/")], (1, 1, 0, 0), [row("u1", "b"), row("u1/"), row("u2"), row("u2")]),
        ([row("u1", "b", D2), row("u9", day=None)], (1, 1, 0, 1), [row("u1", "b"), row("u1/"), row("u2"), row("u2"), row("u1", "b", D2)]),
        ([row("u3", day=D3, ticker=None)], (1, 1, 0, 0), None),
        ([row("u3", day=D3, ticker="")], (0, 0, 0, 0), None),
    ]
    for number, (rows, summary, want) in enumerate(steps):
        before = store.current()[0]
        assert tuple(store.upsert(frame(spark, *rows), dry_run=True)) == summary and store.current()[0] == before
        assert tuple(store.upsert(frame(spark, *rows))) == summary, number
        assert store.current()[0] == before + bool(summary[0])
        assert want is None or held(store) == told(*want), number
    assert held(store, 1) == told(row("u1"))  # older versions stay readable
    assert tuple(store.upsert(frame(spark, *[row("x")]).limit(0))) == (0, 0, 0, 0)


def test_texts_come_back_as_they_were(spark, tmp_path):
    store = DayStore(spark, f"{tmp_path}/store")
    titles = ['quotes "inside" it', "two\nlines", "comma, here", "back\\slash", " blanks ", "ünïcode", '"', "\r\nx"]
    rows = [("s", "S", t, f"u{i}", D1, "9:00 AM ET") for i, t in enumerate(titles)]
    store.upsert(spark.createDataFrame(rows, ROWS))
    assert sorted(r["title"] for r in store.read().collect()) == sorted(titles)
    assert tuple(store.upsert(spark.createDataFrame(rows, ROWS))) == (0, 0, 0, 0)


def test_a_crash_leaves_the_store_as_it_was(spark, tmp_path, monkeypatch):
    store = DayStore(spark, f"{tmp_path}/store")
    store.upsert(frame(spark, row("u1"), row("u2", day=D2)))
    before = held(store)

    def crash(*_):
        raise RuntimeError("the machine is gone")

    for step in ("stage", "commit", "_publish"):
        with monkeypatch.context() as m:
            if step == "stage":  # files are there, nothing names them
                whole = store.stage
                m.setattr(store, "stage", lambda rows, whole=whole: crash(whole(rows)))
            else:
                m.setattr(store, step, crash)
            with pytest.raises(RuntimeError):
                store.upsert(frame(spark, row("u1", "b"), row("u2", "b", D2)))
        assert held(store) == before and held(DayStore(spark, f"{tmp_path}/store")) == before
    half = Path(f"{tmp_path}/store/_manifests/{2:012d}")  # a manifest cut short, as a store without renames may leave it
    half.write_text(daystore.manifest_text({"2026-01-05": [("nowhere.csv", 1)]})[:-15])
    assert held(store) == before
    half.unlink()
    assert tuple(store.upsert(frame(spark, row("u1", "b"), row("u2", "b", D2)))) == (2, 0, 2, 0)
    assert held(store) == told(row("u1", "b"), row("u2", "b", D2))
    gone = store.vacuum(keep=1)
    assert gone >= 4 and held(store) == told(row("u1", "b"), row("u2", "b", D2))


def test_of_two_writers_one_gets_an_error(spark, tmp_path):
    one, two = (DayStore(spark, f"{tmp_path}/store") for _ in range(2))
    one.upsert(frame(spark, row("u0")))
    version = one.current()[0]
    mine, theirs = one.stage(frame(spark, row("u1"))), two.stage(frame(spark, row("u2", day=D2)))
    assert one.commit(mine, version) == version + 1
    with pytest.raises(ConcurrentWriteError):
        two.commit(theirs, version)
    assert held(one) == told(row("u1"))
    # Both see the same last manifest, and the rename decides.
    two.current = lambda: (version, {})
    with pytest.raises(ConcurrentWriteError):
        two.commit(theirs, version)
    del two.current
    assert held(two) == told(row("u1"))
    assert two.commit(theirs, version + 1) == version + 2 and held(one) == told(row("u1"), row("u2", day=D2))
    assert one.commit({}, version + 2, removed=["2026-01-05"]) == version + 3 and held(one) == told(row("u2", day=D2))


def test_random_crawls_against_plain_rules(spark, tmp_path):
    rng, store, want = random.Random(4), DayStore(spark, f"{tmp_path}/store"), {}
    for _ in range(4):
        rows = [row(f"u{rng.randrange(12)}", rng.choice("ab"), rng.choice([D1, D2, D3])) for _ in range(rng.randint(1, 9))]
        added = updated = 0
        changed, after = set(), {d: list(v) for d, v in want.items()}
        for r in rows:
            old = next((x for x in reversed(sorted(want.get(r[2], []))) if x[0] == r[0]), None)
            state = "added" if old is None else "same" if told(old) == told(r) else "updated"
            added, updated = added + (state == "added"), updated + (state == "updated")
            changed |= {r[2]} if state != "same" else set()
        for d in {r[2] for r in rows}:
            mine = [r for r in rows if r[2] == d]
            after[d] = [x for x in after.get(d, []) if x[0] not in {r[0] for r in mine}] + mine
        want = {d: after[d] if d in changed else want[d] for d in after}
        assert tuple(store.upsert(frame(spark, *rows))) == (len(changed), added, updated, 0)
        assert held(store) == told(*(r for day in want.values() for r in day))


def test_only_files_of_wanted_days_are_opened(spark, tmp_path):
    store = DayStore(spark, f"{tmp_path}/store")
    days = [datetime.date(2026, 3, 1) + datetime.timedelta(days=i) for i in range(40)]
    store.upsert(frame(spark, *(row(f"u{i}", day=d) for i, d in enumerate(days) for _ in range(2))))
    for file in Path(f"{tmp_path}/store/_files").glob("*/day=*/part-*.csv"):
        if file.parent.name not in ("day=2026-03-04", "day=2026-03-09"):
            file.unlink()
    day = F.col("day")
    two = store.read().filter(day.isin(days[3], days[8]))
    assert sorted({(r["day"], r["url"]) for r in two.collect()}) == [(days[3], "u3"), (days[8], "u8")]
    assert two.select("source_file").distinct().count() == 2
    assert "day" in two._jdf.queryExecution().executedPlan().toString()
    ranges = [(day > days[2]) & (day < days[4]), (day >= days[3]) & (day <= days[3]), day == days[3], day.isin(days[3]) & day.isin(days[3], days[5])]
    for condition in ranges:
        assert {r["url"] for r in store.read().filter(condition).collect()} == {"u3"}
    assert store.read().filter(day > days[-1]).count() == 0
    with pytest.raises(Exception, match="(?i)no such file|not found|FileNotFound"):
        store.read().filter(day.isin(days[4])).collect()


def test_plain_layout(spark, tmp_path):
    for day in ("2025-12-31", "2026-01-05", "2026-01-06"):
        file = Path(tmp_path, day[:4], f"{day}.csv")
        file.parent.mkdir(exist_ok=True)
        with file.open("w", newline="") as f:
            out = csv.writer(f)
            out.writerow(COLUMNS[:5])  # an older file without times
            out.writerow(["s", "", "a\nb", "u" + day, day])
    Path(tmp_path, "2026", "2026-01-07.csv").touch()  # empty
    store = DayStore(spark, str(tmp_path))
    assert sorted((r["url"][1:], r["title"], r["ticker"], r["publish_time"], r["source_file"]) for r in store.read().collect()) == [(d, "a\nb", "", None, f"{d[:4]}/{d}.csv") for d in ("2025-12-31", "2026-01-05", "2026-01-06")]
    assert store.read().filter(F.year("day") == 2026).count() == 2
    assert store.read().filter(F.col("day") == D1).count() == 1
    assert store.read().filter(F.col("day").isin(D1, D3, datetime.date(2031, 1, 1))).count() == 1


def test_large_days_are_written_by_several_tasks(spark, tmp_path):
    store = DayStore(spark, f"{tmp_path}/store")
    rows = spark.range(4_000).select(*(F.lit("s").alias(c) for c in ("slug", "ticker")), F.format_string("t%05d", "id").alias("title"), F.format_string("u%05d", "id").alias("url"), F.lit(D1).alias("publish_date"), F.lit("").alias("publish_time"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else a day this small is one task's
    try:
        store.upsert(rows.repartition(3))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(store.current()[1]["2026-01-05"]) > 1
    assert [r["title"] for r in store.read().orderBy("ordinal").collect()] == sorted(r["title"] for r in rows.collect())


def test_counts_follow_the_changed_days(spark, tmp_path):
    """Added rows count, replaced ones and removed days do not; files of other days are not opened."""
    store = DayStore(spark, f"{tmp_path}/store")
    assert store.counts().count() == 0
    old = datetime.date(2025, 12, 31)
    crawls = [[row("u1"), row("u2"), row("u3", day=old)], [row("u1", "b"), row("u4", day=D2, ticker=None)], [row("u1", "b", ticker="T")]]
    for rows in crawls:
        store.upsert(frame(spark, *rows))
        want = store.read().groupBy(F.year("day").cast("long").alias("year"), "slug", "ticker").count()
        assert sorted(map(tuple, store.counts().collect())) == sorted(map(tuple, want.collect()))
        for file in Path(f"{tmp_path}/store/_files").glob("*/day=2025-12-31/*.csv"):
            file.rename(f"{tmp_path}/away.csv")
            away = file
        if rows is not crawls[-1]:
            Path(f"{tmp_path}/away.csv").rename(away)
    assert store.changed_days(2, 3) == ["2026-01-05"] and store.changed_days(0, 1) == ["2025-12-31", "2026-01-05"]
    store.upsert(frame(spark, row("u1", "c", ticker="T")))  # the old day's file is away by now
    assert sorted(map(tuple, store.counts().collect())) == [(2025, "s", "S", 1), (2026, "s", "", 1), (2026, "s", "S", 1), (2026, "s", "T", 1)]
    store.commit({}, store.current()[0], removed=["2026-01-06"])
    assert sorted(map(tuple, store.counts().collect())) == [(2025, "s", "S", 1), (2026, "s", "S", 1), (2026, "s", "T", 1)]
