"""URL filters by association rules.

Addresses with a known verdict are market baskets: tokens of the address and the verdict. Spark's FP-growth mines token
combinations that many of them share; those that go with one verdict in nearly all of them, and more often than chance,
become rules. A rule is indexed under its rarest token. An address looks its own tokens up in that index, checks the rest
of each rule found, and takes the verdict of the rule of greatest confidence (then of most baskets, fewest tokens, least text).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.common import Scratch

#: Fixed rules: verdict and host/path.
FIXED = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: A mined rule holds for so large a share of the addresses with a verdict, and for so many of them at least.
SUPPORT, ADDRESSES = 0.01, 8
#: Its verdict has so large a share of those that hold its tokens, and so many times its share among all.
CONFIDENCE, LIFT = 0.9, 1.1
#: FP-growth gets at most so many tokens of one address, those in most addresses. It bounds what it can find in addresses
#: that share a long list of tokens: 2^TOKENS combinations an address, 2^TOKENS / SUPPORT in all. Sets with a rarer token
#: are not lost; they grow by conditional bases, without those that no rule needs.
TOKENS = 10
VERDICTS = ("allow", "block")
FOUND = "tokens array<string>, verdict string, confidence double, n bigint"


def host_of(url: str = "url") -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    host = F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str = "url") -> Column:
    """After the host up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def fixed_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = FIXED) -> Column:
    """verdict and rule of the longest rule that fits; the lesser text on equal lengths; null if none fits."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        of, _, rest = rule.partition("/")
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(f"/{rest}")
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def tokens_of(url: str = "url") -> Column:
    """The distinct tokens of an address: host labels, folders, the last name or its ending, query parameters; digits are one #.

    An address without :// has none.
    """
    host, path = host_of(url), path_of(url)
    parts = F.split(path, "/")
    folders = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    name = F.element_at(parts, -1)
    ending = F.regexp_extract(name, r"\.([^.]*)$", 1)
    query = F.split(F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1), "&")
    lists = [
        F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("host="), x)),
        F.transform(F.filter(folders, lambda x: x != ""), lambda x: F.concat(F.lit("dir="), x)),
        F.array(F.when(name == "", F.lit("")).when(ending != "", F.concat(F.lit("ending="), ending)).otherwise(F.concat(F.lit("name="), name))),
        F.transform(F.filter(query, lambda x: x != ""), lambda x: F.concat(F.lit("query="), F.substring_index(x, "=", 1))),
    ]
    found = F.transform(F.filter(F.concat(*lists), lambda x: (x != "") & (x != "host=")), lambda x: F.regexp_replace(x, "[0-9]+", "#"))
    return F.when(F.col(url).isNull(), F.array().cast("array<string>")).otherwise(F.array_distinct(found))


def frequent(baskets: DataFrame, least: int) -> DataFrame:
    """token, allow, block: the tokens in least baskets (row, verdict, tokens) or more, and how many allowed and blocked ones hold each."""
    single = baskets.select("verdict", F.explode("tokens").alias("token"))
    count = single.groupBy("token").agg(*(F.count(F.when(F.col("verdict") == v, 1)).alias(v) for v in VERDICTS))
    return count.filter(F.col("allow") + F.col("block") >= least)


def held(baskets: DataFrame, count: DataFrame) -> DataFrame:
    """verdict and items (w, token, allow, block) of each basket that holds tokens of count: all of them, those in most baskets first."""
    single = baskets.select("row", "verdict", F.explode("tokens").alias("token"))
    item = F.struct((-F.col("allow") - F.col("block")).alias("w"), "token", *VERDICTS)
    return single.join(count, "token").groupBy("row", "verdict").agg(F.array_sort(F.collect_list(item)).alias("items")).select("verdict", "items")


def useful(token: Column, verdict: str, n: dict[str, int], least: int) -> Column:
    """Whether a rule for the verdict may need the token: it is in least baskets of the verdict, and not in all of the other one's."""
    other = VERDICTS[1 - VERDICTS.index(verdict)]
    return (token[verdict] >= least) & (token[other] < n.get(other, 0))


def grown(items: DataFrame, count: DataFrame, n: dict[str, int], least: int, need: dict[str, float], rare: Callable[[Column], Column], scratch: Scratch) -> DataFrame:
    """tokens, verdict, confidence, n of token sets with a rare token: all that a rule may need, grown by conditional bases.

    The base of a set is the baskets that hold it, cut to the tokens before its own in the order; equal ones are one row
    with a number. A token joins the set if least baskets of the verdict hold both, and if every token of the new set
    keeps off a basket of the other verdict that the rest of the set lets in. A set for which this fails has a subset
    without that token of no less confidence, and so has every set around it; so no rule is lost, and tokens that come
    together or imply each other do not combine. Nor does a base grow if the other verdict's baskets with all its tokens,
    which none of them keeps off, hold every set's confidence below need.
    """
    one = ("aim", "prefix", "up", "left")  # a base: verdict, its set, the set's baskets of the verdict and of the other one
    item = F.struct((-F.col("allow") - F.col("block")).alias("w"), "token", *VERDICTS)
    start = F.array().cast("array<string>").alias("prefix")

    def sets(aim: str, other: str) -> DataFrame:
        told = count.withColumn("x", item).filter(useful(F.col("x"), aim, n, least))
        return told.select(F.lit(aim).alias("aim"), start, "token", F.col(aim).alias("p"), F.col(other).alias("m"), rare(F.col("x")).alias("grows"))

    def rows(aim: str, other: str) -> DataFrame:
        told = F.transform(F.filter("items", lambda x: useful(x, aim, n, least)), lambda x: F.struct(rare(x).alias("rare"), (-x[other]).alias("w"), x["token"].alias("token")))
        n_of = (F.lit(n.get(v, 0)).cast("long").alias(c) for v, c in ((aim, "up"), (other, "left")))
        return items.select(F.lit(aim).alias("aim"), start, *n_of, (F.col("verdict") == aim).alias("hit"), F.transform(F.array_sort(told), lambda x: x["token"]).alias("items"))

    level = scratch.keep(sets(*VERDICTS).unionByName(sets(*VERDICTS[::-1])), "sets0")
    base = rows(*VERDICTS).unionByName(rows(*VERDICTS[::-1]))
    base = scratch.keep(base.groupBy(*one, "hit", "items").agg(F.count("*").alias("k")), "bases0")
    found = []
    while not level.isEmpty():
        found.append(level.filter("grows"))
        told = F.struct("token", F.struct("p", F.when(F.col("grows"), F.col("m")).otherwise(0).alias("m")))
        base = base.join(level.groupBy("aim", "prefix").agg(F.map_from_entries(F.collect_list(told)).alias("of")), ["aim", "prefix"])
        base = base.withColumn("items", F.array_intersect("items", F.map_keys("of")))
        stay = F.sum(F.when(~F.col("hit") & (F.size("items") == F.size("of")), F.col("k")).otherwise(0))
        least_share = F.when(F.col("aim") == "allow", need["allow"]).otherwise(need["block"])
        hopeful = base.groupBy(*one).agg(stay.alias("stay")).filter(F.col("up") >= least_share * (F.col("up") + F.col("stay")))
        base = base.join(hopeful.select("aim", "prefix"), ["aim", "prefix"], "left_semi")
        base = base.select("aim", "prefix", "hit", "items", "k", "of", F.posexplode("items").alias("at", "token")).withColumn("to", F.element_at("of", F.col("token")))
        base = base.filter("to.m > 0 and at > 0").select("aim", F.concat("prefix", F.array("token")).alias("prefix"), F.col("to.p").alias("up"), F.col("to.m").alias("left"), "hit", F.slice("items", F.lit(1), F.col("at")).alias("items"), "k")
        base = scratch.keep(base.groupBy(*one, "hit", "items").agg(F.sum("k").alias("k")), f"bases{len(found)}")
        scratch.drop(f"bases{len(found) - 1}")
        p, m = (F.sum(F.when(hit, F.col("k")).otherwise(0)) for hit in (F.col("hit"), ~F.col("hit")))
        more = base.withColumn("token", F.explode("items")).groupBy(*one, "token").agg(p.alias("p"), m.alias("m"))
        more = more.filter((F.col("p") >= least) & (F.col("m") < F.col("left"))).drop("up", "left").withColumn("grows", F.lit(True))
        less = more.withColumn("y", F.explode(F.sequence(F.lit(0), F.size("prefix") - 1))).withColumn("less", F.filter("prefix", lambda x, i: i != F.col("y")))
        same = less.join(level.select("aim", F.col("prefix").alias("less"), "token", "m"), ["aim", "less", "token", "m"]).select("aim", "prefix", "token").distinct()
        level = scratch.keep(more.join(same, ["aim", "prefix", "token"], "left_anti"), f"sets{len(found)}")
    if not found:
        return scratch.spark.createDataFrame([], FOUND).limit(0)
    confidence = F.col("p") / (F.col("p") + F.col("m"))
    made = reduce(DataFrame.unionByName, found).withColumn("tokens", F.array_sort(F.concat("prefix", F.array("token"))))
    return made.select("tokens", F.col("aim").alias("verdict"), confidence.alias("confidence"), F.col("p").alias("n"))


def mine(labelled: DataFrame, scratch: Scratch, support: float = SUPPORT, addresses: int = ADDRESSES, confidence: float = CONFIDENCE, lift: float = LIFT) -> DataFrame:
    """Rules learned from labelled (url, verdict): tokens, verdict, confidence, n (baskets that hold tokens and verdict), key (the rarest token).

    An address listed often counts once; a null address and one without tokens count in no rule. A rule is dropped if one
    with some of its tokens, the same verdict and no less confidence is there. Without labels, or with one verdict
    only, there are no rules. A rule may combine any number of tokens: FP-growth mines the tokens in most addresses, so
    many that no address holds more than TOKENS of them, and grown() the sets with a rarer one. lift is above 1: a token
    that tells nothing makes no rule.
    """
    none = labelled.sparkSession.createDataFrame([], f"{FOUND}, key string").limit(0)
    rows = labelled.filter(F.col("url").isNotNull() & F.col("verdict").isin(*VERDICTS)).select("url", "verdict").distinct()
    rows = scratch.keep(rows.select(F.struct("url", "verdict").alias("row"), "verdict", tokens_of().alias("tokens")), "baskets")
    total = rows.count()
    least = max(addresses, -int(-support * total // 1))
    if total < least:
        return none
    count = scratch.keep(frequent(rows, least), "tokens")
    baskets = scratch.keep(held(rows, count), "items")
    n = {r["verdict"]: r["n"] for r in baskets.groupBy("verdict").agg(F.count("*").alias("n")).collect()}
    if not n:
        return none
    baskets = baskets.withColumn("items", F.filter("items", lambda x: useful(x, "allow", n, least) | useful(x, "block", n, least)))
    first = baskets.agg(F.min(F.when(F.size("items") > TOKENS, F.get("items", F.lit(TOKENS)))).alias("x")).first()["x"]

    def rare(x: Column) -> Column:
        return (x["w"] > first["w"]) | ((x["w"] == first["w"]) & (x["token"] >= first["token"])) if first else F.lit(False)

    items = F.transform(F.filter("items", lambda x: ~rare(x)), lambda x: x["token"])
    items = baskets.select(F.concat(items, F.array(F.concat(F.lit("="), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / sum(n.values()), minConfidence=confidence).fit(items)
    of = {f"={v}": F.lit(v) for v in VERDICTS}
    found = model.associationRules.filter(F.element_at("consequent", 1).isin(*of))
    n_rule = F.round(F.col("support") * sum(n.values())).cast("long")
    found = found.select(F.array_sort("antecedent").alias("tokens"), F.substring(F.element_at("consequent", 1), 2, 9).alias("verdict"), "confidence", n_rule.alias("n"))
    found = found.filter(~F.exists("tokens", lambda t: t.isin(*of)))
    if first:
        need = {v: max(confidence, lift * n.get(v, 0) / sum(n.values())) * (1 - 1e-9) for v in VERDICTS}  # a little less, for rounding
        found = found.unionByName(grown(baskets, count, n, least, need, rare, scratch))
    share = F.when(F.col("verdict") == "allow", F.lit(n.get("allow", 0) / sum(n.values()))).otherwise(F.lit(n.get("block", 0) / sum(n.values())))
    found = found.filter((F.col("confidence") >= confidence) & (F.col("confidence") / share >= lift))
    single = count.select(F.col("token").alias("t"), (F.col("allow") + F.col("block")).alias("f"))
    keys = found.select("tokens", "verdict", "confidence", "n", F.explode("tokens").alias("t")).join(single, "t")
    found = scratch.keep(keys.groupBy("tokens", "verdict", "confidence", "n").agg(F.min_by("t", F.struct("f", "t")).alias("key")), "found")
    fewer = found.select(*(F.col(c).alias(f"{c}0") for c in ("tokens", "verdict", "confidence", "key")))
    wide = found.select("tokens", "verdict", "confidence", F.explode("tokens").alias("t"))
    inside = (F.col("t") == F.col("key0")) & (F.col("verdict") == F.col("verdict0")) & (F.size("tokens0") < F.size("tokens")) & (F.col("confidence0") >= F.col("confidence"))
    spare = wide.join(fewer, inside).filter(F.size(F.array_except("tokens0", "tokens")) == 0).select("tokens", "verdict").distinct()
    return scratch.keep(found.join(spare, ["tokens", "verdict"], "left_anti"), "rules")


def judge(pages: DataFrame, rules: DataFrame, fixed: tuple[tuple[str, str], ...] = FIXED, otherwise: str = "allow") -> DataFrame:
    """pages (page_id, url) with host, path, rule (of the fixed ones), verdict and mined (tokens of the mined rule that decided) of every row.

    The longest fixed rule that fits decides, else the best mined rule whose tokens the address holds, else otherwise. A
    null address has an empty host and path and no tokens.
    """
    told = pages.select("page_id", "url", host_of().alias("host"), path_of().alias("path"), F.monotonically_increasing_id().alias("row"))
    told = told.withColumn("fixed", fixed_rule(F.col("host"), F.col("path"), fixed))
    open_tokens = F.when(F.col("fixed").isNull(), tokens_of()).otherwise(F.array().cast("array<string>"))
    each = told.withColumn("tokens", open_tokens).withColumn("token", F.explode_outer("tokens"))
    place = F.struct((-F.col("confidence")).alias("c"), (-F.col("n")).alias("n"), F.size("tokens").alias("size"), "tokens", "verdict")
    index = rules.select("key", F.col("tokens").alias("needed"), place.alias("place"))
    # Spark broadcasts the index if it is small, as it mostly is: rules have been written, so their size is known.
    hits = each.join(index, (F.col("token") == F.col("key")) & (F.size(F.array_except("needed", "tokens")) == 0), "left")
    best = hits.groupBy("row", "page_id", "url", "host", "path", "fixed").agg(F.min("place").alias("best"))
    verdict = F.coalesce("fixed.verdict", "best.verdict", F.lit(otherwise)).alias("verdict")
    return best.select("page_id", "url", "host", "path", F.col("fixed.rule").alias("rule"), verdict, F.col("best.tokens").alias("mined"))


def verdicts(pages: DataFrame, scratch: Scratch, fixed: tuple[tuple[str, str], ...] = FIXED) -> DataFrame:
    """judge() of all pages by rules that are mined from the verdicts of the fixed ones: pages that a fixed rule fits are the labelled ones."""
    rule = fixed_rule(host_of(), path_of(), fixed)
    labelled = pages.select("url", rule["verdict"].alias("verdict")).filter("verdict is not null")
    return judge(pages, mine(labelled, scratch), fixed)
