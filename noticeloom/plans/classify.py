"""Which platform a page is from, and what follows from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.functions import urls

#: By priority, platform and what its pages hold; "tags" where a comment does not count.
FINGERPRINTS = (
    ("notified", r"""(?i)<meta(?=[^>]*name\s*=\s*["']?generator["'\s/>])(?=[^>]*content\s*=\s*["'][^"'>]*drupal)""", "tags"),
    ("investis", r"(?i)investis\s+sitecore\s+common\s+gtm|delivered\s+by\s+investis|investisdigital\.com|(?:https?:)?//(?:www\.)?investis\.com\b"),
    ("investorroom", "(?i)investorroom"),
    ("investorroom", r"""(?i)<a\b[^>]*href\s*=\s*["'][^"'>]*(?:[?&](?:amp;)?item=\d|/\d{4}-\d{2}-\d{2}-[^/#"'>]+/?["'])""", "tags"),
    ("q4", r"""(?i)<a\b[^>]*href\s*=\s*["'][^"'>]*/news-details/\d{4}/[^/"'>]""", "tags"),
    ("q4", r"(?i)news/default\.aspx"),
    ("notified", r"""(?i)<a\b[^>]*href\s*=\s*["'][^"'>]*/(?:news-releases|press-releases|financial-releases)/[^/#?"'>]+/[^/#?"'>]""", "tags"),
    ("aem", r"(?i)/etc\.clientlibs/|/content/dam/"),
)
#: Strategies that belong to a platform of another name.
STRATEGY_PLATFORM = {"q4_ir": "q4", "notified_gated": "notified", "aem_bny": "aem", "aem_cme": "aem"}
GATED = ("tjx", "robinhood", "caseys")
AEM = {"bny": "aem_bny", "cme": "aem_cme"}


def detect_platform(html: Column, fingerprints: tuple[tuple[str, ...], ...] = FINGERPRINTS, segment: Column | None = None, news_path: Column | None = None) -> Column:
    """The first fingerprint that a page shows; unknown without any, and for null pages.

    segment and news_path, where a source gives them, stand for the details segment and the listing path of its Q4 site.
    """
    tags, out = F.regexp_replace(html, r"(?s)<!--.*?-->", ""), None
    for platform, shape, *where in fingerprints:
        shown = (tags if where else html).rlike(shape)
        if platform == "q4" and where and segment is not None:
            own = F.concat(F.lit(r"""(?i)<a\b[^>]*href\s*=\s*["'][^"'>]*/\Q"""), segment, F.lit(r"""\E/\d{4}/[^/"'>]"""))
            shown = F.when(F.coalesce(segment, F.lit("")) == "", shown).otherwise(F.rlike(tags, own))
        if platform == "q4" and not where and news_path is not None:
            path = F.lower(F.btrim(urls.fill_year(news_path, F.lit(None).cast("int")), F.lit("/")))
            shown = F.when(F.coalesce(news_path, F.lit("")) == "", shown).otherwise(F.contains(F.lower(html), path))
        out = F.when(shown, platform) if out is None else out.when(shown, platform)
    return out.otherwise("unknown")


def strategy_of(platform: Column, slug: Column) -> Column:
    slug = F.lower(F.trim(slug))
    out = F.when(platform == "q4", "q4_ir").when((platform == "notified") & slug.isin(*GATED), "notified_gated")
    for known, strategy in AEM.items():
        out = out.when((platform == "aem") & (slug == known), strategy)
    return out.otherwise(platform)


def platform_of(strategy: Column) -> Column:
    out = strategy
    for name, platform in STRATEGY_PLATFORM.items():
        out = F.when(strategy == name, platform).otherwise(out)
    return out


#: The field that holds a platform's listing path, and the path without it.
LISTING = {"q4": ("news_path", "news/default.aspx"), "investorroom": ("news_releases_path", "news-releases"), "notified": ("news_releases_path", "news-releases"), "notified_gated": ("news_releases_path", "investors/press-releases"), "investis": ("news_releases_path", "news-releases"), "aem": ("aem_listing_path", "")}


def listing_url(platform: Column, ir_url: Column, news_url: Column, paths: dict[str, Column] | None = None) -> Column:
    """The address of a source's list of releases; an unknown platform has its root, no base gives nothing."""
    base, out = urls.scrape_url(news_url, ir_url), None
    for name, (field, default) in LISTING.items():
        path = urls.first_given((paths or {}).get(field, F.lit(None).cast("string")), F.lit(default))
        path = urls.fill_year(path, F.lit(None).cast("int")) if name == "q4" else path
        made = urls.join_path(base, path)
        out = F.when(platform == name, made) if out is None else out.when(platform == name, made)
    return F.when(base == "", "").otherwise(out.otherwise(base))


def inconsistencies(configured: DataFrame, detected: DataFrame) -> DataFrame:
    """Configured slugs (slug, strategy) that were not detected, or as something else."""
    found = detected.select(F.col("slug").alias("_s"), F.col("strategy").alias("detected"))
    both = configured.join(found, F.col("slug") == F.col("_s"), "left").drop("_s")
    problem = F.when(F.col("detected").isNull(), "missing").when(F.col("detected") != F.col("strategy"), "mismatch")
    return both.withColumn("problem", problem).filter(F.col("problem").isNotNull())


#: What a platform is told by.
DESCRIPTIONS = {
    "aem": "Adobe Experience Manager sites",
    "investis": "Investis Digital sites",
    "investorroom": "InvestorRoom sites",
    "notified": "Notified/Drupal sites",
    "notified_gated": "Notified/Drupal sites behind a gate",
    "q4": "Q4 sites",
}


def describe_platforms() -> list[str]:
    """The registry's platforms, sorted, in columns of fixed width."""
    width = max(map(len, DESCRIPTIONS))
    return [f"{name.ljust(width)}  {DESCRIPTIONS[name]}" for name in sorted(DESCRIPTIONS)]


def registry_faults() -> list[str]:
    """Names that one table of the registry has and another lacks; there must be none."""
    platforms = set(LISTING)
    told = {p for p, *_ in FINGERPRINTS}
    return sorted({f"no description: {p}" for p in platforms - set(DESCRIPTIONS)} | {f"no listing: {p}" for p in told - platforms} | {f"no platform: {p}" for p in set(STRATEGY_PLATFORM.values()) - platforms})


assert not registry_faults(), registry_faults()
