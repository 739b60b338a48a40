"""The registered queries of this package: each runs an operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F  # noqa: F401

from mailspark.llm import (
    byte_bpe, clustering, fingerprints, jaccard_join, line_dedup, mixing, periodic_runs, quality_classifier, quality_rules, substring_dedup,
    token_files, toxicity, url_filter,
)
from mailspark.llm.common import documents, table, words
from mailspark.session import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


@query("op7_quality_rules")
def _quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judged(documents(spark, folder), columns=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


_MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS symbols,
         (CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 13) AS BIGINT) AS DOUBLE) + 1) / 4503599627370496 AS u
  FROM documents),
keyed AS (SELECT doc_id, source, size, pow(u, 1 / ((size + 1) / (size + 1 + symbols))) AS priority FROM sized),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [1.0::DOUBLE, 2, 3][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS INT) + 1] AS share
  FROM keyed GROUP BY source),
levels AS (
  SELECT *, (sum(CAST(source_size AS DOUBLE)) OVER () - coalesce(sum(3.0::DOUBLE * source_size) OVER before, 0))
            / (sum(share) OVER () - coalesce(sum(share) OVER before, 0)) AS level, 3.0::DOUBLE * source_size / share AS full_at
  FROM totals
  WINDOW before AS (ORDER BY 3.0::DOUBLE * source_size / share, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT source, source_size,
         least(3.0::DOUBLE * source_size, share * (SELECT arg_min(level, full_at) FROM levels WHERE level <= full_at)) AS target
  FROM levels),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM goals),
ranked AS (
  SELECT k.*, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS budget,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.priority DESC) AS upto,
         sum(k.size) OVER (PARTITION BY k.source, k.priority) AS alike
  FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source),
gaps0 AS (
  SELECT *, upto <= budget AS taken, budget - coalesce(max(CASE WHEN upto <= budget THEN upto END) OVER (PARTITION BY source), 0) AS gap FROM ranked),
""" + "".join(f"""
fits{i} AS (
  SELECT source, arg_max(priority, (-abs(alike - gap), priority)) AS fit, arg_max(alike, (-abs(alike - gap), priority)) AS more
  FROM gaps{i} WHERE NOT taken AND abs(alike - gap) < gap GROUP BY source),
gaps{i + 1} AS (
  SELECT g.* EXCLUDE (taken, gap), taken OR coalesce(priority = fit, false) AS taken, gap - coalesce(more, 0) AS gap
  FROM gaps{i} g LEFT JOIN fits{i} f ON g.source IS NOT DISTINCT FROM f.source),
""" for i in range(mixing.FITS)) + f"""
done AS (SELECT * FROM gaps{mixing.FITS})
SELECT doc_id, size, source_size, target, CAST(size * (epochs + CASE WHEN taken THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM done
"""


@query("op2_mixing", _MIX_SQL)
def _mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, folder), columns=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


@query("op3_byte_bpe")
def _byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers as public

    path, pattern = public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN
    encoded = byte_bpe.encoded(documents(spark, folder), path, pattern, columns=["doc_id"], digest=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.col("raw_sha256").alias("decoded_sha256"),
    )


@query("op6_token_files")
def _token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers as public

    docs, out = documents(spark, folder), work_dir(spark, "tokens")
    token_files.write(docs, out, public.path("byte_bpe_50k.json"), end=2)

    return token_files.read(spark, out, checksum=True).select(F.col("doc").alias("doc_id"), "start", "n_tokens", F.col("crc32").alias("ids_crc32"))


@query("op1_quality_classifier")
def _quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = documents(spark, folder), table(spark, folder, "labels")
    model = quality_classifier.learnt(quality_classifier.sample(docs, labels, "quality"))
    scored = quality_classifier.scored(docs, model, columns=["doc_id"])
    return scored.select("doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op10_toxicity")
def _toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = documents(spark, folder), table(spark, folder, "labels")
    categories = toxicity.by_language(docs, labels)
    chain = toxicity.learnt(toxicity.sample(docs, labels, categories), tuple(categories))
    return toxicity.scored(docs, chain, columns=["doc_id"]).select("doc_id", "score", "toxic", F.to_json("categories").alias("categories"))


@query("op9_fingerprints")
def _fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.against_next(documents(spark, folder)).select(
        F.col("id").alias("doc_id"), F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


_LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, no, line
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS no FROM documents)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
runs AS (
  SELECT doc_id, no, lead(no) OVER w AS last, line || chr(10) || lead(line) OVER w AS run FROM lines
  WINDOW w AS (PARTITION BY doc_id ORDER BY no)
  UNION ALL SELECT doc_id, no, no, line FROM lines WHERE length(line) >= 40),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, no) AS place FROM runs WHERE run IS NOT NULL),
gone AS (
  SELECT doc_id, no FROM placed WHERE place > 1 UNION SELECT doc_id, last FROM placed WHERE place > 1),
split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
kept AS (
  SELECT s.doc_id, l, coalesce(list(g.no) FILTER (g.no IS NOT NULL), []) AS nos
  FROM split s LEFT JOIN gone g USING (doc_id) GROUP BY s.doc_id, l)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(nos) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_transform(list_filter(range(1, len(l) + 1), lambda i: NOT list_contains(nos, i)), lambda i: l[i]), chr(10))) AS kept_sha256
FROM kept
"""


@query("op5_line_dedup", _LINES_SQL)
def _line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.deduplicated(documents(spark, folder)).select(
        "doc_id", F.col("__lines").cast("long").alias("n_lines"), F.col("__gone").cast("long").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


@query("op8_jaccard_join")
def _jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.joined(documents(spark, folder)).withColumnRenamed("id", "doc_id")


_WINDOWS_SQL = r"""
WITH w AS (
  SELECT doc_id, i, word FROM (
    SELECT doc_id, unnest(l) AS word, generate_subscripts(l, 1) AS i
    FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS l FROM documents))),
windows AS (
  SELECT doc_id, i, """ + " || ' ' || ".join(f"lead(word, {j}) OVER o" for j in range(13)) + r""" AS win
  FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
first AS (SELECT win, min(doc_id) AS least FROM windows WHERE win IS NOT NULL GROUP BY win),
hits AS (SELECT doc_id, i FROM windows JOIN first USING (win) WHERE doc_id > least),
marked AS (
  SELECT w.doc_id, w.i, w.word, count(h.i) OVER (PARTITION BY w.doc_id ORDER BY w.i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) > 0 AS gone
  FROM w LEFT JOIN hits h ON w.doc_id = h.doc_id AND w.i = h.i),
sums AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN sums s ON d.doc_id = s.doc_id
"""


@query("op4_substring_dedup", _WINDOWS_SQL)
def _substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.deduplicated(documents(spark, folder)).select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def _clusters_sql() -> str:
    """Rounds as one CTE each: every vector's squared distance to every centroid, the nearest, the floors of the means."""
    size, scale, clusters = clustering.SIZE, clustering.SCALE, clustering.CLUSTERS
    sql = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: isfinite(x))) = {size}),
parts AS MATERIALIZED (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM kept),
first AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT *, sha256(concat('1:', vec_id)) AS h FROM kept ORDER BY h, v LIMIT {clusters})),
c0 AS MATERIALIZED (SELECT c, unnest(v) AS y, generate_subscripts(v, 1) AS d FROM first)"""
    for i in range(clustering.ROUNDS + 1):
        sql += f""",
a{i} AS MATERIALIZED (
  SELECT r, arg_min(c, struct_pack(far := far, c := c)) AS c, min(far) AS far
  FROM (SELECT r, c, CAST(sum((x - y) * (x - y)) AS BIGINT) AS far FROM parts JOIN c{i} USING (d) GROUP BY r, c) GROUP BY r)"""
        if i < clustering.ROUNDS:
            sql += f""",
m{i} AS (SELECT c, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM parts JOIN a{i} USING (r) GROUP BY c, d),
c{i + 1} AS MATERIALIZED (
  SELECT o.c, o.d, CASE WHEN n IS NULL THEN y ELSE (s - ((s % n) + n) % n) // n END AS y FROM c{i} o LEFT JOIN m{i} m ON o.c = m.c AND o.d = m.d)"""
    last = clustering.ROUNDS
    return sql + f""",
digests AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY d)) AS digest FROM c{last} GROUP BY c)
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, far AS distance, CAST(sum(far) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(far) OVER () AS BIGINT) AS inertia, digest AS centroid_sha256
FROM a{last} a JOIN kept USING (r) JOIN digests g ON g.c = a.c
"""


@query("op11_centroid_clustering", _clusters_sql())
def _centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.clustered(table(spark, folder, "embeddings"), columns=["vec_id"])


@query("op12_periodic_runs")
def _periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every tenth document by hash is made periodic from one of its words on; then all are searched."""
    digits = F.col("doc_id").cast("string")
    docs = documents(spark, folder).select("doc_id", "text", F.crc32(digits.cast("binary")).alias("h"))
    docs = docs.select("doc_id", "text", F.when(F.col("h") % 10 == 0, words(F.col("text"))).alias("w"), F.floor(F.col("h") / 10).alias("g"))
    docs = docs.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    docs = docs.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    edited = F.expr("array_join(transform(sequence(0, n - 1), i -> get(w, CAST(IF(i < a, i, a + (i - a) % p) AS INT))), ' ')")
    docs = docs.select("doc_id", F.when(F.col("n") > 0, edited).otherwise(F.col("text")).alias("text"))
    found = periodic_runs.found(docs, columns=["doc_id"])
    # Runs come by start, then period: the first of the greatest exact ratio stays.
    best = "aggregate(runs, CAST(NULL AS struct<start: bigint, length: bigint, period: bigint>), (b, r) -> IF(b IS NULL OR r.length * b.period > b.length * r.period, r, b))"
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n"))))
    found = found.withColumn("best", F.expr(best))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col("best")[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _url_sql() -> str:
    def shrunk(level: str, key: str, m: str) -> str:
        return f"SELECT {key}, (k + {m} * above) / (n + {m}) AS mean FROM {level}, {level}_m"

    def strength(level: str) -> str:
        weak, strong = url_filter.WEAKEST, url_filter.STRONGEST
        return f"""{level}_m AS MATERIALIZED (
  SELECT CASE WHEN coalesce(together, 0) = 0 OR (scatter - alone) / together <= 1 / ({strong} + 1) THEN {strong}::DOUBLE
              ELSE greatest({weak}::DOUBLE, together / (scatter - alone) - 1) END AS m
  FROM (SELECT sum(n * (k / n - above) * (k / n - above)) AS scatter, sum(above * (1 - above)) AS alone, sum(above * (1 - above) * (n - 1)) AS together
        FROM {level} WHERE n > 0))"""

    listed = "|".join(s.replace(".", r"\.") for s in sorted(url_filter.SUFFIXES, key=len, reverse=True))
    longest = sorted(url_filter.RULES, key=lambda r: (-len(r[1]), r[1]))
    fits = {text: f"(host = '{text.partition('/')[0]}' OR ends_with(host, '.{text.partition('/')[0]}')) AND starts_with(path, '/{text.partition('/')[2]}')" for _, text in longest}
    rules = " ".join(f"WHEN {fits[text]} THEN '{text}'" for _, text in longest)
    verdicts = " ".join(f"WHEN '{text}' THEN '{verdict}'" for verdict, text in longest)
    return rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS MATERIALIZED (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
l AS (SELECT doc_id, bool_or(quality = 0 OR toxic = 1) AS bad FROM labels GROUP BY doc_id),
counted AS (
  SELECT host, regexp_replace(host, '(?s)^.*@|\.?(:\d*)?$', '', 'g') AS bare, count(bad) AS n, count(*) FILTER (bad) AS k
  FROM p LEFT JOIN l ON doc_id = TRY_CAST(regexp_extract(path, '^/[^/]*/([0-9]+)', 1) AS BIGINT) GROUP BY host),
ended AS (
  SELECT *, CASE WHEN regexp_matches(bare, '^(\d+(\.\d+){{3}}|\[.*)$') THEN bare ELSE regexp_extract(bare, '(?:^|\.)({listed}|[^.]*)$', 1) END AS suffix FROM counted),
named AS MATERIALIZED (
  SELECT *, CASE WHEN length(bare) <= length(suffix) + 1 THEN bare
                 ELSE concat(string_split(left(bare, length(bare) - length(suffix) - 1), '.')[-1], '.', suffix) END AS domain FROM ended),
total AS (SELECT (sum(k) + 0.5::DOUBLE) / (sum(n) + 1) AS above FROM named),
tops AS MATERIALIZED (SELECT suffix, n, k, above FROM (SELECT suffix, sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k FROM named GROUP BY suffix), total),
{strength('tops')},
top_means AS ({shrunk('tops', 'suffix', 'm')}),
domains AS MATERIALIZED (SELECT domain, n, k, mean AS above FROM (SELECT suffix, domain, sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k FROM named GROUP BY suffix, domain) JOIN top_means USING (suffix)),
{strength('domains')},
domain_means AS ({shrunk('domains', 'domain', 'm')}),
hosts AS MATERIALIZED (SELECT host, n, k, mean AS above FROM (SELECT host, domain, n::DOUBLE AS n, k::DOUBLE AS k FROM named) JOIN domain_means USING (domain)),
{strength('hosts')},
rated AS (SELECT host, n, k, m, (k + m * above) / (n + m) AS rate FROM hosts, hosts_m),
judged AS (
  SELECT page_id, p.host, path, CASE {rules} END AS rule, n::BIGINT AS n_labelled, k::BIGINT AS n_bad,
         CASE WHEN rate - {url_filter.BOUND} * sqrt(rate * (1 - rate) / (n + m + 1)) > {url_filter.LIMIT} THEN 'block' ELSE 'allow' END AS by_host
  FROM p LEFT JOIN rated USING (host))
SELECT page_id, host, path, rule, coalesce(CASE rule {verdicts} END, by_host) AS verdict, n_labelled, n_bad FROM judged
"""


@query("op13_url_filter", _url_sql())
def _url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A page's outcome is that of the document its url names: bad where that is labelled poor or toxic."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = table(spark, folder, "labels").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    number = F.regexp_extract(url_filter.path(F.col("url")), "^/[^/]*/([0-9]+)", 1).try_cast("bigint")
    known = pages.withColumn("of", number).join(labels, F.col("of") == F.col("doc_id"), "left")
    judged = url_filter.judged(pages, url_filter.reputation(known), columns=["page_id"])
    return judged.select("page_id", "host", "path", "rule", "verdict", F.col("n").alias("n_labelled"), F.col("k").alias("n_bad"))
