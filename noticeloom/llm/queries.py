"""The operators as registered queries: whole tables in, contracted columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.llm import bpe, elkan, licenses, lines, mixing, multiset, ngram_lm, pii, quality, runs, simhash, toxicity, url_rules
from noticeloom.llm.common import Scratch


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_copies(documents(spark, sf_dir).select("doc_id", "text", "source")).drop("copies")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = quality.quality_rules(documents(spark, sf_dir), Scratch(spark))
    return made.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = pii.pseudonymise(documents(spark, sf_dir).select("doc_id", "text"), key="noticeloom example key")
    return made.select("doc_id", "n_entities", "text")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def vocabulary_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_round_trip(documents(spark, sf_dir), vocabulary_path())


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(documents(spark, sf_dir).select("doc_id", "text"))


def op8_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op9_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset.edited_fingerprints(documents(spark, sf_dir))


def op10_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.lm_scores(documents(spark, sf_dir))


def op11_elkan_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return elkan.cluster_report(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_report(runs.with_planted_runs(documents(spark, sf_dir)))


def op13_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = url_rules.verdicts(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), Scratch(spark))
    return made.select("page_id", "host", "path", "rule", "verdict", F.array_join("mined", " ").alias("mined"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pareto_mix, op2_line_dedup, op3_quality_rules, op4_pii_surrogates, op5_toxicity, op6_bpe_round_trip, op7_license_scan, op8_simhash_groups, op9_multiset_fingerprints, op10_backoff_lm, op11_elkan_clusters, op12_periodic_runs, op13_url_rules)
}
#: Runs of lines with 50 words or more, the shortest from each line on and back to each line; all but the first copy go.
LINES_SQL = """WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text) AS r, doc_id, text, string_split(text, chr(10)) AS a FROM (SELECT DISTINCT doc_id, text FROM documents)),
l AS (SELECT r, unnest(range(len(a))) AS i, unnest(a) AS line FROM d),
w AS (SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n FROM l),
s AS (SELECT r, i, line, n, row_number() OVER (PARTITION BY r ORDER BY i) AS p, sum(n) OVER (PARTITION BY r ORDER BY i) AS upto FROM w WHERE n > 0),
pairs AS (SELECT a.r, a.p AS a, b.p AS b FROM s a JOIN s b ON a.r = b.r AND b.p BETWEEN a.p AND a.p + 49 AND b.upto - a.upto + a.n >= 50),
runs AS (SELECT r, a, min(b) AS b FROM pairs GROUP BY ALL UNION SELECT r, max(a), b FROM pairs GROUP BY r, b),
texts AS (SELECT x.r, x.a, x.b, string_agg(s.line, chr(10) ORDER BY s.p) AS t FROM runs x JOIN s ON s.r = x.r AND s.p BETWEEN x.a AND x.b GROUP BY ALL),
later AS (SELECT r, a, b FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY r, a) AS k FROM texts) WHERE k > 1),
gone AS (SELECT DISTINCT s.r, s.i, s.p FROM s JOIN later x ON s.r = x.r AND s.p BETWEEN x.a AND x.b),
stretch AS (SELECT x.r, x.i AS lo, y.i AS hi FROM gone x JOIN gone y ON x.r = y.r AND y.p = x.p + 1),
kept AS (SELECT l.* FROM l WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.r = l.r AND g.i = l.i) AND NOT EXISTS (SELECT 1 FROM stretch t WHERE t.r = l.r AND l.i > t.lo AND l.i < t.hi)),
k AS (SELECT r, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS t FROM kept GROUP BY r)
SELECT o.doc_id, coalesce(CAST(len(d.a) AS BIGINT), 0) AS n_lines, coalesce(CAST(len(d.a) AS BIGINT), 0) - coalesce(k.n, 0) AS n_cut, CAST(length(coalesce(k.t, '')) AS BIGINT) AS n_chars_left, sha256(coalesce(k.t, '')) AS kept_sha256
FROM documents o LEFT JOIN d ON o.doc_id IS NOT DISTINCT FROM d.doc_id AND o.text IS NOT DISTINCT FROM d.text LEFT JOIN k ON d.r = k.r"""


def _clusters_sql(k: int = 16, rounds: int = 3) -> str:
    """Lloyd's rounds as they are told: every vector with every centroid, in integers."""
    parts = [
        """v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"c0 AS (SELECT row_number() OVER (ORDER BY h, e) - 1 AS j, e FROM (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, e FROM v ORDER BY h, e LIMIT {k}))",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS (SELECT r, vec_id, e, j, d FROM (SELECT v.r, v.vec_id, v.e, c.j, list_sum(list_transform(range(1, 65), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i]))) AS d, row_number() OVER (PARTITION BY v.r ORDER BY list_sum(list_transform(range(1, 65), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i]))), c.j) AS place FROM v, c{i} c) WHERE place = 1)""")
        if i < rounds:
            parts.append(f"""m{i} AS (SELECT j, list(x ORDER BY i) AS e FROM (SELECT j, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (SELECT j, i, sum(x) AS s, count(*) AS n FROM (SELECT j, unnest(range(64)) AS i, unnest(e) AS x FROM a{i}) GROUP BY j, i)) GROUP BY j),
c{i + 1} AS (SELECT c.j, coalesce(m.e, c.e) AS e FROM c{i} c LEFT JOIN m{i} m ON c.j = m.j)""")
    return f"""WITH {", ".join(parts)}
SELECT a.vec_id, CAST(a.j AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.j = c.j"""


#: Runs of equal distances between equal words; crc32 bit by bit.
RUNS_SQL = r"""WITH h AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
xor(list_reduce(flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1])), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, CAST(4294967295 AS BIGINT)), 4294967295) AS h FROM documents),
g AS (SELECT r, doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS edit, (h // 10) % greatest(len(w), 1) AS a, h // 10 AS g FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM g),
e AS (SELECT r, doc_id, n, CASE WHEN edit THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w FROM p),
t AS (SELECT r, n, unnest(range(n)) AS i, unnest(w) AS w FROM e),
pairs AS (SELECT x.r, y.i - x.i AS q, x.i AS i FROM t x JOIN t y ON x.r = y.r AND x.w = y.w AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
stretches AS (SELECT r, q, min(i) AS s, count(*) + q AS l FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM pairs) GROUP BY r, q, k HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS (SELECT r, s, l, min(q) AS q FROM stretches GROUP BY r, s, l),
told AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM runs GROUP BY r),
best AS (SELECT r, s, l, q FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY CAST(l AS DOUBLE) / q DESC, s, q) AS k FROM runs) WHERE k = 1),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT t.r, string_agg(t.w, ' ' ORDER BY t.i) AS t FROM t LEFT JOIN gone ON t.r = gone.r AND t.i = gone.i WHERE gone.r IS NULL GROUP BY t.r)
SELECT e.doc_id, coalesce(told.n_runs, 0) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.l AS BIGINT) AS length, CAST(best.q AS BIGINT) AS period, CAST(1000 * best.l // best.q AS BIGINT) AS exponent_milli, sha256(coalesce(told.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM e LEFT JOIN told ON e.r = told.r LEFT JOIN best ON e.r = best.r LEFT JOIN kept ON e.r = kept.r"""
#: All combinations of each labelled address's tokens counted one by one instead of FP-growth, all rules tried on all addresses.
URLS_SQL = r"""WITH u AS (SELECT row_number() OVER () AS r, page_id, url, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
f AS (SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/' WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/' WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/' WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule,
string_split(path, '/') AS parts, string_split(coalesce(regexp_extract(url, '://[^?#]*\?([^#]*)', 1), ''), '&') AS query FROM u),
s AS (SELECT *, CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block' WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow' END AS told, parts[len(parts)] AS name FROM f),
t AS (SELECT *, CASE WHEN url IS NULL THEN [] ELSE list_distinct(list_transform(list_filter(list_concat(list_transform(string_split(host, '.'), lambda x: 'host=' || x), list_transform(list_filter(parts[1:len(parts) - 1], lambda x: x <> ''), lambda x: 'dir=' || x),
[CASE WHEN name = '' THEN '' WHEN regexp_extract(name, '\.([^.]*)$', 1) <> '' THEN 'ending=' || regexp_extract(name, '\.([^.]*)$', 1) ELSE 'name=' || name END], list_transform(list_filter(query, lambda x: x <> ''), lambda x: 'query=' || split_part(x, '=', 1))), lambda x: x <> '' AND x <> 'host='), lambda x: regexp_replace(x, '[0-9]+', '#', 'g'))) END AS tokens FROM s),
l AS (SELECT row_number() OVER () AS r, url, told, any_value(tokens) AS tokens FROM t WHERE told IS NOT NULL AND url IS NOT NULL GROUP BY url, told),
total AS (SELECT greatest(8, CAST(ceil(CAST(0.01 AS DOUBLE) * count(*)) AS BIGINT)) AS least, count(*) AS n, count(*) FILTER (told = 'allow') AS allow, count(*) FILTER (told = 'block') AS block FROM l),
x AS (SELECT r, told, unnest(tokens) AS token FROM l),
w AS (SELECT token, abs(count(*) FILTER (told = 'block') * (SELECT allow FROM total) - count(*) FILTER (told = 'allow') * (SELECT block FROM total)) AS weight FROM x GROUP BY token HAVING count(*) >= (SELECT least FROM total)),
ten AS (SELECT r, told, token FROM (SELECT x.*, row_number() OVER (PARTITION BY r ORDER BY w.weight DESC, x.token) AS k FROM x JOIN w ON x.token = w.token) WHERE k <= 10),
b AS (SELECT r, told, list(token ORDER BY token) AS items FROM ten GROUP BY r, told),
m AS (SELECT told, items, unnest(range(1, 1 << len(items))) AS mask FROM b),
c AS (SELECT list_filter(items, lambda t, i: (mask >> (i - 1)) & 1 = 1) AS tokens, told FROM m),
n AS (SELECT tokens, count(*) AS n, count(*) FILTER (told = 'allow') AS allow, count(*) FILTER (told = 'block') AS block FROM c GROUP BY tokens),
of AS (SELECT told, count(*) AS n FROM b GROUP BY told),
r AS (SELECT n.tokens, of.told, CASE of.told WHEN 'allow' THEN n.allow ELSE n.block END AS n, CAST(CASE of.told WHEN 'allow' THEN n.allow ELSE n.block END AS DOUBLE) / n.n AS confidence, CAST(of.n AS DOUBLE) / (SELECT count(*) FROM b) AS share FROM n, of),
rules AS (SELECT r.tokens, r.told, row_number() OVER (ORDER BY r.confidence DESC, r.n DESC, len(r.tokens), r.tokens, r.told) AS place FROM r, total WHERE r.n >= total.least AND total.n >= total.least AND r.confidence >= CAST(0.9 AS DOUBLE) AND r.confidence / r.share >= CAST(1.1 AS DOUBLE)),
hits AS (SELECT t.r, min(place) AS place FROM t JOIN rules ON list_has_all(t.tokens, rules.tokens) WHERE t.told IS NULL GROUP BY t.r)
SELECT t.page_id, t.host, t.path, t.rule, coalesce(t.told, rules.told, 'allow') AS verdict, array_to_string(rules.tokens, ' ') AS mined FROM t LEFT JOIN hits ON t.r = hits.r LEFT JOIN rules ON hits.place = rules.place"""
ORACLES: dict[str, str] = {"op2_line_dedup": LINES_SQL, "op11_elkan_clusters": _clusters_sql(), "op12_periodic_runs": RUNS_SQL, "op13_url_rules": URLS_SQL}
