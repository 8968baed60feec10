"""Pages as nodes in document order, and which node lies in which.

A node's stretch [node, until) of the document order holds all that is below it, so an ancestor is an interval and a link
or text a point. Within a page the parser has met all nodes in order: a page is one row of arrays, in which the texts of an
element are a slice, its nearest card is named by its place, and whether a card holds another link is told by the two links
that stand before and behind those of one address. Every step is linear in the page, and nothing is shuffled.

Where intervals and points are tables of their own, contained() joins them. It cuts each interval into blocks of the dyadic
grid, of which it needs two a level at most, and gives each point its block on every level; a point in an interval lies in
exactly one of its blocks. So the join is an equality on page, level and block: no page is compared node by node, and a page
of any size is spread over tasks. It is a sort-merge join by hint: Spark's estimates know nothing of what the grid
multiplies, and by them it would collect a whole side at the driver to broadcast it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.functions import dates, html, urls
from noticeloom.operators.extract import small

#: Levels of the grid: documents of 2^LEVELS nodes.
LEVELS = 31


def outline(pages: DataFrame, **above: tuple[str, ...]) -> DataFrame:
    """pages (page_id, base_url, html) to page_id, base_url, texts (array) and elements (array), both in document order.

    above: by name, the tags of which each element's nearest ancestor is told. elements holds those of any of these tags and
    the links: node and until, the number and end in document order; first and last, the texts [first, last) that lie in it,
    counted from 0; tag, href, label (aria-label); and by each name the place in elements of that ancestor, null without one.

    Pages are parsed once, in Arrow batches. Texts of scripts and styles are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts, texts_to, columns, to = [], [0], [[] for _ in kinds], [0]
            for text in batch.column("html").to_pylist():
                page = html.Page(text or "")
                heard = [page.tag[holder] not in ("script", "style") for holder in page.holder]
                texts += [said for said, is_heard in zip(page.text, heard) if is_heard]
                number = [*accumulate(heard, initial=0)]
                of = [n for n, tag in enumerate(page.tag) if tag in known or tag == "a" and "href" in page.attrs[n]]
                place = {n: i for i, n in enumerate(of)}
                values = [of, [page.end[n] for n in of], [number[page.first_text[n]] for n in of], [number[page.last_text[n]] for n in of], [page.tag[n] for n in of]]
                values += [[page.attrs[n].get(a) for n in of] for a in ("href", "aria-label")]
                for tags in above.values():
                    nearest: list[int | None] = []
                    for up in page.parent:
                        nearest.append(None if up < 0 else place[up] if page.tag[up] in tags else nearest[up])
                    values.append([nearest[n] for n in of])
                for column, more in zip(columns, values):
                    column += more
                texts_to.append(len(texts))
                to.append(len(columns[0]))
            elements = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], [*kinds])
            made = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), values) for at, values in ((texts_to, pa.array(texts, pa.string())), (to, elements))]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("base_url"), *made], ["page_id", "base_url", "texts", "elements"])

    known = {tag for tags in above.values() for tag in tags}
    kinds = dict.fromkeys(("node", "until", "first", "last"), pa.int32()) | dict.fromkeys(("tag", "href", "label"), pa.string()) | dict.fromkeys(above, pa.int32())
    element = ", ".join(f"{name}: {'int' if kind == pa.int32() else 'string'}" for name, kind in kinds.items())
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "base_url", "html").mapInArrow(run, f"page_id {kind}, base_url string, texts array<string>, elements array<struct<{element}>>")


def _blocks(low: Column, high: Column) -> Column:
    """The blocks (level, block) of the grid that make up [low, high)."""
    kind = "struct<low:bigint,high:bigint,made:array<struct<level:int,block:bigint>>>"
    start = F.struct(low.cast("bigint").alias("low"), high.cast("bigint").alias("high"), F.array().cast("array<struct<level:int,block:bigint>>").alias("made")).cast(kind)

    def block(when: Column, level: Column, number: Column) -> Column:
        none = F.array().cast("array<struct<level:int,block:bigint>>")
        return F.when(when, F.array(F.struct(level.cast("int").alias("level"), number.alias("block")))).otherwise(none)

    def step(s: Column, level: Column) -> Column:
        is_open = s["low"] < s["high"]
        left, right = is_open & (s["low"] % 2 == 1), is_open & (s["high"] % 2 == 1)
        made = F.concat(s["made"], block(left, level, s["low"]), block(right, level, s["high"] - 1))
        return F.struct(F.shiftright(s["low"] + left.cast("bigint"), 1).alias("low"), F.shiftright(s["high"] - right.cast("bigint"), 1).alias("high"), made.alias("made")).cast(kind)

    levels = F.length(F.bin(F.greatest(high - low, F.lit(0))))  # each halves what is left
    return F.aggregate(F.sequence(F.lit(0), levels), start, step, lambda s: s["made"])


def contained(outer: DataFrame, inner: DataFrame, low: str, high: str, point: str, top: str | None = None) -> DataFrame:
    """Each row of outer (page_id, low, high, ...) with each row of inner (page_id, point, ...) of the same page that lies in [low, high).

    top: a column of inner that no high of its page is above; a point then has as many levels as that number has bits.
    """
    cut = outer.withColumn("_b", F.explode(_blocks(F.col(low), F.col(high)))).select("*", F.col("_b.level").alias("_level"), F.col("_b.block").alias("_block")).drop("_b")
    levels = F.length(F.bin(F.col(top))) if top else F.lit(LEVELS)
    grid = F.transform(F.sequence(F.lit(0), levels), lambda level: F.struct(level.alias("level"), F.call_function("shiftright", F.col(point), level).alias("block")))
    points = inner.withColumn("_b", F.explode(grid)).select("*", F.col("_b.level").alias("_level"), F.col("_b.block").alias("_block")).drop("_b", top or "_b")
    return cut.join(points.hint("merge"), ["page_id", "_level", "_block"]).drop("_level", "_block")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def said(texts: Column, by: str) -> Column:
    """The texts without blanks around them, those that are left, in one."""
    return F.array_join(F.filter(F.transform(texts, lambda t: strip(t)), lambda t: t != ""), by)


def texts_in(element: Column) -> Column:
    return F.slice("texts", element["first"] + 1, element["last"] - element["first"])


def q4_links(pages: DataFrame, segment: str, climb: int) -> DataFrame:
    """page_id, place, url, label, own, instead and boxes of the links that give an item, as arrays of texts.

    Of links to one address the first that has a title gives it: words of its own, or instead those of the card around it.
    boxes are the cards around the link, nearest first, climb at most, up to the first that holds a release with another
    href. So a text is in boxes of one link only, and all boxes of a page hold climb times its texts at most.
    """
    table = outline(pages, box=("li", "article", "div", "section"), card=("li", "article", "div"))
    at = lambda array, place: F.get(F.col(array), place)
    worded = lambda texts: F.exists(texts, lambda t: t.rlike(r"(?U)\S"))

    def titled(link: Column) -> Column:
        card = at("elements", link["card"])
        return worded(texts_in(link)) | F.coalesce(worded(texts_in(card)), F.lit(False))

    def apart(start: Column, run: Column) -> Column:
        """Links in a row with one href, each with the nodes of the links before and behind these."""
        behind = at("starts", run + 1)
        before, after = at("links", start - 1)["node"].alias("before"), at("links", behind)["node"].alias("after")
        row = F.filter(F.slice("links", start + 1, F.coalesce(behind, F.size("links")) - start), titled)
        fields = ("first", "last", "label", "box", "card")
        return F.transform(row, lambda x: F.struct(strip(x["href"]).alias("href"), x["node"].alias("place"), *(x[f].alias(f) for f in fields), before, after))

    def resolved(link: Column) -> Column:
        return F.struct(urls.resolve(F.col("base_url"), link["href"]).alias("url"), *(link[f] for f in ("place", "first", "last", "label", "box", "card", "before", "after")))

    def told(link: Column) -> Column:
        up = [at("elements", link["box"])]
        while len(up) < climb:
            up.append(at("elements", up[-1]["box"]))
        alone = lambda b: b.isNotNull() & (link["before"].isNull() | (link["before"] < b["node"])) & (link["after"].isNull() | (link["after"] >= b["until"]))
        instead = F.when(~worded(texts_in(link)), texts_in(at("elements", link["card"])))
        boxes = F.transform(F.filter(F.array(*up), alone), lambda b: texts_in(b))
        return F.struct("page_id", link["place"].cast("bigint").alias("place"), link["url"].alias("url"), link["label"].alias("label"), texts_in(link).alias("own"), instead.alias("instead"), boxes.alias("boxes"))

    detail = rf"(?i)/{segment}/\d{{4}}/[^/]+/?(?:default\.aspx)?"
    table = table.withColumn("links", F.filter("elements", lambda e: (e["tag"] == "a") & e["href"].rlike(detail)))
    starts = F.filter(F.transform("links", lambda x, i: i), lambda i: (i == 0) | (at("links", i)["href"] != at("links", i - 1)["href"]))
    table = table.withColumn("starts", starts).withColumn("sorted", F.sort_array(F.transform(F.flatten(F.transform("starts", apart)), resolved)))
    first = F.filter("sorted", lambda x, i: (i == 0) | ~x["url"].eqNullSafe(at("sorted", i - 1)["url"]))
    return table.select(F.inline(F.transform(first, told)))


def q4_items(pages: DataFrame, segment: str = "news-details") -> DataFrame:
    """pages (page_id, base_url, html) to page_id, place, title, url, publish_date, raw_date_text and category of Q4 listings, as html.q4 reads them.

    place is the link's number in document order. The date is the first one in the nearest card around the link, up to five,
    that holds no other release, outside the link's own words; else the last one in the link's label.
    """
    links = q4_links(pages, segment, 5)
    contexts = F.transform("boxes", lambda box: said(F.filter(box, lambda t: ~F.array_contains("own", t)), " "))
    none = F.struct(F.lit(None).cast("date").alias("date"), F.lit("").alias("raw"))

    def step(so_far: Column, context: Column) -> Column:
        """The cards are read outward until one holds a date."""
        category = F.coalesce(so_far["category"], *(F.when(F.contains(context, F.lit(c)), F.lit(c)) for c in html.CATEGORIES))
        read = F.struct(F.when(context == "", none).otherwise(dates.parse_date(context)).alias("day"), category.alias("category"))
        return F.when(so_far["day"]["date"].isNotNull(), so_far).otherwise(read)

    start = F.struct(none.alias("day"), F.lit(None).cast("string").alias("category"))
    made = links.withColumn("told", F.aggregate(contexts, start, step))
    label = F.when(F.col("told.day.date").isNull() & (F.col("label") != ""), dates.parse_trailing_date(F.col("label")))
    title = F.when(F.col("instead").isNull(), said(F.col("own"), "")).otherwise(said(F.col("instead"), " "))
    made = made.select("page_id", "place", title.alias("title"), "url", F.coalesce(label, "told.day").alias("day"), F.coalesce("told.category", F.lit("")).alias("category"))
    return made.select("page_id", "place", "title", "url", F.col("day.date").alias("publish_date"), F.coalesce("day.raw", F.lit("")).alias("raw_date_text"), "category")
