"""Dates and times in heterogeneous text, as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names, and by priority the shapes of dates, each with the groups that hold year, month and day.
MONTHS = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec|January|February|March|April|May|June|July|August|September|October|November|December"
SHAPES = (
    (rf"\b({MONTHS})\.?\s+(\d{{1,2}}),\s+(\d{{4}})\b", (3, 1, 2)),
    (rf"\b(\d{{1,2}})\s+({MONTHS}),?\s+(\d{{4}})\b", (3, 2, 1)),
    (r"\b(\d{1,2})/(\d{1,2})/(\d{4})\b", (3, 1, 2)),
    (r"\b(\d{4})-(\d{2})-(\d{2})\b", (1, 2, 3)),
)
#: Clock times with a zone, their parts, and what may stand around a date or time that is alone.
TIME = r"\b\d{1,2}:\d{2}\s*[AaPp]\.?[Mm]\.?\s+[A-Z]{2,5}\b"
TIME_PARTS = r"^(\d{1,2}):(\d{2})\s*([AaPp])\.?[Mm]\.?\s+[A-Z]{2,5}$"
BARE = " \t\r\n-–—|·•.,:"
#: The months by their first three letters: a month's number follows from its place.
INITIALS = "JanFebMarAprMayJunJulAugSepOctNovDec"


def _real_date(year: Column, month: Column, day: Column) -> Column:
    """The date, or null where there is none such; the month is a name or a number."""
    named = ((F.instr(F.lit(INITIALS), F.substring(month, 1, 3)) + 2) / 3).cast("int").cast("string")
    return F.try_to_date(F.concat_ws("-", year, F.when(month.rlike(r"^\d"), month).otherwise(named), day), "yyyy-M-d")


def _found(text: Column, last: bool) -> Column:
    """struct(date, raw): by shape first, by place second, the first match that is a real date."""
    picks = []
    for shape, order in SHAPES:
        matches = F.regexp_extract_all(text, F.lit(shape), F.lit(0))

        def read(m: Column, shape: str = shape, order: tuple[int, ...] = order) -> Column:
            return F.struct(_real_date(*(F.regexp_extract(m, shape, i) for i in order)).alias("date"), F.trim(m).alias("raw"))

        real = F.filter(F.transform(matches, _unary(read)), lambda c: c["date"].isNotNull())
        picks.append(F.try_element_at(real, F.lit(-1 if last else 1)))
    return F.coalesce(*picks, F.struct(F.lit(None).cast("date").alias("date"), F.lit("").alias("raw")))


def _unary(f):
    """A function of one argument: transform() passes an index to any second one."""
    return lambda m: f(m)


def parse_date(text: Column) -> Column:
    return _found(F.coalesce(text, F.lit("")), last=False)


def parse_trailing_date(text: Column) -> Column:
    return _found(F.coalesce(text, F.lit("")), last=True)


def parse_short_date(text: Column) -> Column:
    """struct(date, raw) of the first m/d/yy of this century; if that one is no date, none is."""
    shape = r"\b(\d{1,2})/(\d{1,2})/(\d{2})\b"
    m, d, y = (F.regexp_extract(text, shape, i) for i in (1, 2, 3))
    date = F.try_to_date(F.concat_ws("/", m, d, F.concat(F.lit("20"), y)), "M/d/yyyy")
    return F.struct(date.alias("date"), F.when(date.isNotNull(), F.regexp_extract(text, shape, 0)).otherwise("").alias("raw"))


def parse_time(text: Column) -> Column:
    """The first clock time with a zone, as written; empty if there is none."""
    return F.trim(F.regexp_extract(F.coalesce(text, F.lit("")), TIME, 0))


def time_sort_key(time: Column) -> Column:
    """struct(missing, hour, minute): times with a zone in day order, everything else behind them."""
    hour, minute, half = (F.regexp_extract(time, TIME_PARTS, i) for i in (1, 2, 3))
    known = hour != ""
    h = F.pmod(F.when(known, hour).otherwise("0").cast("int"), F.lit(12)) + F.when(F.lower(half) == "p", 12).otherwise(0)
    zero = F.lit(0)
    return F.struct(F.when(known, 0).otherwise(1).alias("missing"), F.when(known, h).otherwise(zero).alias("hour"), F.when(known, minute.cast("int")).otherwise(zero).alias("minute"))


def _from_groups(url: Column, shape: str, order: tuple[int, int, int]) -> Column:
    y, m, d = (F.regexp_extract(url, shape, i) for i in order)
    return F.try_to_date(F.concat_ws("-", y, m, d), "yyyy-M-d")


def date_from_url(url: Column, platform: str) -> Column:
    """The date that a platform's detail addresses hold, or null."""
    dashed = _from_groups(url, r"/(\d{4})-(\d{2})-(\d{2})-", (1, 2, 3))
    slashed = _from_groups(url, r"/(\d{4})/(\d{1,2})/(\d{1,2})(?:/|$)", (1, 2, 3))
    return {
        "investorroom": dashed,
        "investis": _from_groups(url, r"/news-releases/\d{4}/(\d{2})-(\d{2})-(\d{4})-\d+", (3, 1, 2)),
        "aem_bny": F.coalesce(slashed, dashed),
        "aem_cme": _from_groups(url, r"/(\d{4})/(\d{1,2})/(\d{1,2})", (1, 2, 3)),
    }[platform]


def resolve_publish_date(card: Column, raw: Column, url: Column) -> Column:
    """struct(date, raw, conflict): the card's date wins; the address's one stands in and is told in ISO form."""
    return F.struct(
        F.coalesce(card, url).alias("date"),
        F.when(card.isNotNull(), raw).when(url.isNotNull(), url.cast("string")).otherwise("").alias("raw"),
        F.coalesce(card.isNotNull() & (url != card), F.lit(False)).alias("conflict"),
    )


def time_of_card(published: Column, card: Column, time: Column) -> Column:
    """A card's time counts only with the card's date."""
    return F.when(published.eqNullSafe(card) & card.isNotNull(), time).otherwise("")


def year_epoch_range(year: Column, zone: str = "America/New_York") -> Column:
    """struct(begin_ms, end_ms): midnight of the first and of the last day of a year, in the zone."""
    def at(month: int, day: int) -> Column:
        return F.unix_millis(F.to_utc_timestamp(F.make_date(year, F.lit(month), F.lit(day)).cast("timestamp"), zone))
    return F.struct(at(1, 1).alias("begin_ms"), at(12, 31).alias("end_ms"))


def iso_prefix(value: Column) -> Column:
    """The date that a machine-readable attribute begins with."""
    return F.try_to_date(F.regexp_extract(value, r"^(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")


def is_bare(text: Column, raw: Column) -> Column:
    """Whether nothing but separators is left of text without the first raw in it."""
    at = F.instr(text, raw)
    rest = F.when((raw != "") & (at > 0), F.concat(F.substring(text, F.lit(1), at - 1), F.substring(text, at + F.length(raw), F.length(text)))).otherwise(text)
    return F.btrim(rest, F.lit(BARE)) == ""


def is_iso_shape(text: Column) -> Column:
    return text.rlike(r"^\d{4}-\d{2}-\d{2}$")


def day_path(date: Column, root: str = "data") -> Column:
    return F.concat(F.lit(f"{root}/"), F.year(date), F.lit("/"), date.cast("string"), F.lit(".csv"))


def year_ranges(years: set[int] | None, date: Column) -> Column:
    """A filter of years as date ranges, which reach a scan; None keeps everything."""
    if years is None:
        return F.lit(True)
    out = F.lit(False)
    for y in sorted(years):
        out = out | ((date >= F.lit(f"{y:04d}-01-01").cast("date")) & (date < F.lit(f"{y + 1:04d}-01-01").cast("date")))
    return out
