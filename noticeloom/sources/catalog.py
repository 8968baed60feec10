"""The source catalog and the scraper configuration."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.functions import urls
from noticeloom.functions.html import first_table
from noticeloom.plans.classify import platform_of

FIELDS = ("slug", "name", "ticker", "ir_url", "news_url", "news_releases_path", "first_page_index", "notes", "needs_detail_page_dates", "news_path", "news_details_segment", "aem_listing_path", "aem_item_selector")
DESCRIBED = ("slug", "name", "ticker", "ir_url", "news_url", "news_path", "news_details_segment", "news_releases_path")
REQUIRED = ("slug", "name", "ir_url")
SOURCES = ", ".join(f"{f} {'int' if f == 'first_page_index' else 'boolean' if f == 'needs_detail_page_dates' else 'string'}" for f in FIELDS)


def _yaml(spark: SparkSession, path: str):
    """Content of a YAML file wherever Spark reads files; a folder that Spark wrote one into will do. Catalogs are small: a record for each source."""
    import yaml

    return yaml.safe_load("".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))


def load_sources(spark: SparkSession, path: str) -> DataFrame:
    """The catalog, a list or one under the key sources, with its file order as ordinal. A record without a required field, or a text that YAML read as something else, is an error."""
    rows, told = [], _yaml(spark, path) or []
    for i, record in enumerate(told.get("sources") or [] if isinstance(told, dict) else told):
        for field in FIELDS:
            value = record.get(field)
            if field in REQUIRED and not value:
                raise ValueError(f"record {i} of {path} has no {field}")
            if value is not None and field not in ("first_page_index", "needs_detail_page_dates") and not isinstance(value, str):
                raise ValueError(f"{field} of record {i} of {path} is not a text: {value!r}")
        rows.append((i, *(record.get(f) for f in FIELDS)))
    return spark.createDataFrame(rows, f"ordinal int, {SOURCES}")


def described(sources: DataFrame) -> DataFrame:
    """The catalog's columns that a detection report takes, what is not given as empty text."""
    return sources.select("ordinal", *(F.coalesce(c, F.lit("")).alias(c) for c in DESCRIBED))


def load_config(spark: SparkSession, path: str) -> DataFrame:
    """group, module, slug, args, ordinal: a row for each configured source; a group's name is its strategy."""
    rows = []
    for group, body in (_yaml(spark, path) or {}).items():
        for entry in body.get("sources") or []:
            rows.append((group, body.get("scraper"), entry.get("slug"), [str(a) for a in entry.get("args") or []], len(rows)))
    return spark.createDataFrame(rows, "group string, module string, slug string, args array<string>, ordinal int")


def configured_platforms(config: DataFrame) -> DataFrame:
    made = config.filter(F.col("slug").isNotNull())
    return made.select("slug", F.col("group").alias("strategy"), platform_of(F.col("group")).alias("platform"), "ordinal")


def find_source(sources: DataFrame, query: str, field: str | None = None) -> DataFrame:
    """The first record whose slug or ticker is the query, without regard to case and blanks around it."""
    q = F.lower(F.trim(F.lit(query)))
    match = F.lit(False)
    for f in (field,) if field else ("slug", "ticker"):
        match = match | (F.lower(F.trim(f)) == q)
    return sources.filter(F.coalesce(match, F.lit(False))).orderBy("ordinal").limit(1)


def find_by_url(sources: DataFrame, addresses: DataFrame, faithful: bool = False) -> DataFrame:
    """addresses (url) with the slug of the first source on the same host, null if there is none."""
    hosts = sources.select("ordinal", "slug", F.explode(F.array("ir_url", "news_url")).alias("u"))
    hosts = hosts.withColumn("host", urls.host_key(F.col("u"), faithful)).filter("host <> ''")
    first = hosts.groupBy("host").agg(F.min_by("slug", "ordinal").alias("slug"))
    return addresses.withColumn("host", urls.host_key(F.col("url"), faithful)).join(first, "host", "left")


def selected(config: DataFrame, platform: str | None = None, slug: str | None = None) -> DataFrame:
    out = config
    if platform:
        out = out.filter(F.lower("group") == platform.lower())
    return out.filter(F.lower("slug") == slug.lower()) if slug else out


def signatures(config: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """config with the signature that its sources are sampled by: module, sorted arguments, durable facts."""
    out = config if facts is None else config.join(facts.select("slug", "needs_detail_page_dates"), "slug", "left")
    durable = F.lit(None).cast("boolean") if facts is None else F.col("needs_detail_page_dates")
    return out.withColumn("signature", F.to_json(F.struct("module", F.array_sort("args").alias("args"), durable.alias("needs_detail_page_dates"))))


def canonical_json(value: Column) -> Column:
    """One text for all JSON texts of one value: objects by their keys, numbers by their values, no white space; lists keep their order. Text that is no JSON stands for itself behind a tilde, which begins no JSON; null is JSON's null."""
    return F.coalesce(F.to_json(F.try_parse_json(value)), F.concat(F.lit("~"), value), F.lit("null"))


def nested_signatures(config: DataFrame) -> DataFrame:
    """config (module, args: array of JSON texts, nested to any depth) with a signature in which neither the order of arguments nor that of keys counts."""
    args = F.array_sort(F.transform(F.coalesce("args", F.array().cast("array<string>")), canonical_json))
    return config.withColumn("signature", F.to_json(F.struct(F.col("module"), args.alias("args"))))


def tickers(sources: DataFrame) -> DataFrame:
    return sources.select(urls.canonical_ticker(F.col("ticker")).alias("ticker")).filter("ticker <> ''").distinct()


def index_tickers(pages: DataFrame, heading: str = "Symbol") -> DataFrame:
    """The distinct tickers, in the catalog's spelling, that the first table of each page (html) has under the heading."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [row.get(heading, "") for page in batch.column("html").to_pylist() for row in first_table(page)]
            yield pa.RecordBatch.from_arrays([pa.array(told, pa.string())], ["ticker"])

    return tickers(pages.select("html").mapInArrow(run, "ticker string"))


def arguments(slug: str, year: int | None = None, extra: tuple[str, ...] = (), dry_run: bool = False, data_dir: str | None = None) -> list[str]:
    """The options that an extractor's run for one source is given."""
    out = ["--slug", slug, *(["--year", str(year)] if year is not None else []), *extra, *(["--dry-run"] if dry_run else [])]
    return out + (["--data-dir", data_dir] if data_dir is not None else [])


def upsert_source(sources: DataFrame, record: DataFrame) -> DataFrame:
    """The record in place of the one with its ticker, or added; in slug order. A slug that another ticker has is an error."""
    taken = record.select("slug", F.col("ticker").alias("_t")).join(sources.select("slug", "ticker"), "slug").filter(~F.col("ticker").eqNullSafe(F.col("_t")))
    if not taken.isEmpty():
        raise ValueError(f"slug {taken.first()['slug']} belongs to another source")
    return sources.join(record.select("ticker"), "ticker", "left_anti").unionByName(record, allowMissingColumns=True).orderBy("slug")


def _spans(text: str) -> list[tuple[int, int, dict]]:
    """First line, line behind the last, and content of each record of a catalog; comments between records are in no span."""
    import yaml

    def last(node) -> int:
        if isinstance(node, yaml.ScalarNode):
            return node.end_mark.line + (node.end_mark.column > 0)
        inner = [x for pair in node.value for x in pair] if isinstance(node, yaml.MappingNode) else node.value
        own = [] if inner and not node.flow_style else [node.end_mark.line + (node.end_mark.column > 0)]
        return max([*own, *map(last, inner)])

    root = yaml.compose(text)
    records = yaml.safe_load(text) or []
    return [(node.start_mark.line, last(node), record) for node, record in zip(root.value if root else [], records)]


def saved_text(text: str, record: dict) -> str:
    """A catalog's text with the record in place of the one with its ticker, or added before the first greater slug; no other line changes.

    A record is replaced by the lines that it stands on; comments within these go, all others stay. A slug that another
    ticker has is an error. If the new slug breaks the order, the record moves.
    """
    import yaml

    lines, spans = text.splitlines(keepends=True), _spans(text)
    if lines and not lines[-1].endswith("\n"):
        lines[-1] += "\n"
    same = next((i for i, (_, _, r) in enumerate(spans) if record.get("ticker") and r.get("ticker") == record["ticker"]), None)
    if any(r.get("slug") == record["slug"] and i != same for i, (_, _, r) in enumerate(spans)):
        raise ValueError(f"slug {record['slug']} belongs to another source")
    made = yaml.safe_dump([{k: v for k, v in record.items() if v is not None}], sort_keys=False, allow_unicode=True, width=10**6).splitlines(keepends=True)
    others = [s for i, s in enumerate(spans) if i != same]
    if same is not None:
        begin, end, _ = spans[same]
        before, after = [r["slug"] for _, _, r in spans[:same]], [r["slug"] for _, _, r in spans[same + 1 :]]
        if all(x < record["slug"] for x in before) and all(x > record["slug"] for x in after):
            return "".join(lines[:begin] + made + lines[end:])
        lines[begin:end] = []
        others = [(b - (end - begin) * (b > begin), e - (end - begin) * (b > begin), r) for b, e, r in others]
    at = next((b for b, _, r in others if r["slug"] > record["slug"]), len(lines))
    while 0 < at < len(lines) and lines[at - 1].lstrip().startswith("#"):  # the next record's own comment stays with it
        at -= 1
    return "".join(lines[:at] + made + lines[at:])


def save_source(path: str, record: dict) -> None:
    """saved_text of the catalog file, written beside it and put in its place by one rename; a new file if there is none."""
    import os

    text = open(path, encoding="utf-8", newline="").read() if os.path.exists(path) else ""
    with open(f"{path}.new", "w", encoding="utf-8", newline="") as f:
        f.write(saved_text(text, record))
    os.replace(f"{path}.new", path)


def platform_map(spark: SparkSession, path: str) -> DataFrame:
    """slug and platform of a detection report, as text and without reading any value as null; no file gives no rows."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], "slug string, platform string")
    return spark.read.csv(path, header=True, escape='"', multiLine=True).select("slug", "platform").na.fill("")


def read_checked(spark: SparkSession, paths: list[str], columns: tuple[str, ...]) -> DataFrame:
    """CSV files that must all have these columns, as one table of text."""
    out = None
    for path in paths:
        made = spark.read.csv(path, header=True, escape='"', multiLine=True)
        missing = [c for c in columns if c not in made.columns]
        if missing:
            raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
        made = made.select(*columns)
        out = made if out is None else out.unionByName(made)
    return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns)) if out is None else out


def read_text_table(spark: SparkSession, path: str) -> DataFrame:
    """Any CSV as text; short rows are filled with nulls, long ones cut to the header."""
    return spark.read.csv(path, header=True, escape='"', multiLine=True, mode="PERMISSIVE", inferSchema=False)


def distinct_queries(queries: DataFrame) -> DataFrame:
    """queries (query, ordinal) once each without regard to case and blanks around them, in the first spelling."""
    key = F.lower(F.trim("query"))
    return queries.filter(key != "").groupBy(key.alias("key")).agg(F.min_by("query", "ordinal").alias("query"), F.min("ordinal").alias("ordinal")).drop("key").orderBy("ordinal")


def slug_taken(sources: DataFrame, slug: str, ticker: str | None) -> bool:
    """Whether a source with another ticker has the slug."""
    same = F.lower("slug") == slug.strip().lower()
    return not sources.filter(same & ~F.col("ticker").eqNullSafe(F.lit(ticker))).isEmpty()


def conflicts(wanted: DataFrame, sources: DataFrame) -> DataFrame:
    """wanted (slug, ticker) with taken: whether a source with another ticker has the slug. Sources are grouped by slug first, so a row comes back once."""
    key = F.lower(F.trim("slug"))
    held = sources.groupBy(key.alias("_key")).agg(F.collect_set(F.coalesce("ticker", F.lit(""))).alias("_held"))
    other = F.exists("_held", lambda t: t != F.coalesce(F.col("ticker"), F.lit("")))
    return wanted.join(held, key == F.col("_key"), "left").withColumn("taken", F.coalesce(other, F.lit(False))).drop("_key", "_held")


def with_required(requests: DataFrame, sources: DataFrame, *columns: str) -> DataFrame:
    """requests (slug) with the columns of the first source of their slug; the job fails, naming the slug, if the catalog lacks one."""
    key = F.lower(F.trim("slug"))
    first = sources.groupBy(key.alias("_key")).agg(F.min_by(F.struct(*columns), "ordinal").alias("_found"))
    lost = F.raise_error(F.concat(F.lit("no source has the slug "), F.coalesce("slug", F.lit(""))))
    found = F.when(F.col("_found").isNull(), lost.cast(first.schema["_found"].dataType)).otherwise(F.col("_found")).alias("_found")
    return requests.join(first, key == F.col("_key"), "left").select(*requests.columns, found).select(*requests.columns, *(F.col(f"_found.{c}").alias(c) for c in columns))


def required(sources: DataFrame, slug: str):
    """The record of a slug; there being none is an error."""
    row = find_source(sources, slug, "slug").first()
    if row is None:
        raise LookupError(f"no source has the slug {slug!r}")
    return row


def with_identity(requests: DataFrame, sources: DataFrame, default_slug: str = "", default_ticker: str = "") -> DataFrame:
    """requests (url, slug, ticker; empty where not given) with the catalog's slug and ticker.

    A given slug or ticker that the catalog has decides; without one the address's host does, then the defaults. base is
    the address's root, and extra its query as array of struct(k, v).
    """
    s = sources.select("ordinal", F.col("slug").alias("s_slug"), F.col("ticker").alias("s_ticker"))
    by = {}
    for name, column in (("slug", "s_slug"), ("ticker", "s_ticker")):
        key = F.lower(F.trim(column))
        by[name] = s.filter(key != "").groupBy(key.alias(f"key_{name}")).agg(F.min_by(F.struct("s_slug", "s_ticker"), "ordinal").alias(f"of_{name}"))
    out = requests.withColumn("host", urls.host_key(F.col("url")))
    for name, side in by.items():
        out = out.join(side, F.lower(F.trim(name)) == F.col(f"key_{name}"), "left")
    hosts = sources.select("ordinal", "slug", "ticker", F.explode(F.array("ir_url", "news_url")).alias("u")).withColumn("h", urls.host_key(F.col("u"))).filter("h <> ''")
    hosts = hosts.groupBy("h").agg(F.min_by(F.struct(F.col("slug").alias("s_slug"), F.col("ticker").alias("s_ticker")), "ordinal").alias("of_host"))
    found = F.coalesce("of_slug", "of_ticker", "of_host")
    out = out.join(hosts, F.col("host") == F.col("h"), "left").withColumn("found", found)
    slug = F.coalesce("found.s_slug", F.nullif(F.trim("slug"), F.lit("")), F.lit(default_slug))
    ticker = F.coalesce("found.s_ticker", F.nullif(F.trim("ticker"), F.lit("")), F.lit(default_ticker))
    return out.select("url", slug.alias("slug"), ticker.alias("ticker"), F.col("found").isNotNull().alias("known"), urls.site_root(F.col("url")).alias("base"), urls.params(urls.query_of(F.col("url"))).alias("extra"))


def resolved_sources(sources: DataFrame, detected: DataFrame) -> DataFrame:
    """The catalog with platform, strategy, listing address and the platforms' own settings, defaults filled in."""
    from noticeloom.plans.classify import listing_url, strategy_of

    side = detected.select(F.col("slug").alias("_s"), "platform")
    out = sources.join(side, F.col("slug") == F.col("_s"), "left").drop("_s").withColumn("platform", F.coalesce("platform", F.lit("unknown")))
    out = out.withColumn("strategy", strategy_of(F.col("platform"), F.col("slug")))
    listed = F.when(F.col("strategy") == "notified_gated", F.col("strategy")).otherwise(F.col("platform"))
    paths = {f: F.col(f) for f in ("news_path", "news_releases_path", "aem_listing_path")}
    out = out.withColumn("listing", listing_url(listed, F.col("ir_url"), F.coalesce("news_url", F.lit("")), paths))
    return out.withColumn("news_details_segment", urls.first_given(F.col("news_details_segment"), F.lit("news-details"))).withColumn("first_page_index", F.coalesce("first_page_index", F.lit(0))).withColumn("needs_detail_page_dates", F.coalesce("needs_detail_page_dates", F.lit(False)))
