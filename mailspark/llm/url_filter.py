"""URL filters with an empirical-Bayes reputation of hosts.

Pages with a known outcome (good or bad) are counted per host, registered domain and suffix.  The
share of bad pages is shrunk from the top down: each level's beta-binomial prior has its parent's
mean, and a strength estimated from how far the shares of that level scatter around their parents'.
A host is blocked where the lower bound of its posterior share lies above ``limit``; rules over
host and path go before that verdict.

Everything is a column expression.  What crosses to the driver is one strength per level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import packed, unpacked, written

#: (verdict, host/path): fits the host, its subdomains, and paths that start alike; the longest wins.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Suffixes of more than one label under which domains are registered; else it is the last label.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "com.cn", "co.in", "co.kr")
LIMIT = 0.5
#: Standard deviations between the posterior mean and its lower bound.
BOUND = 1.645
#: A level's strength stays within these bounds (in pages).
WEAKEST, STRONGEST = 1.0, 10_000.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#``; A-Z in lower case; else empty."""
    return F.translate(_rest(url, r"^([^/?#]*)"), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; else empty."""
    return _rest(url, r"^[^/?#]*([^?#]*)")


def _rest(url: Column, pattern: str) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.regexp_extract(url.substr(at + 3, F.length(url)), pattern, 1)).otherwise(F.lit(""))


def suffix(name: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """Of a host without user and port: the longest listed suffix, else the last label."""
    bare = _bare(name)
    listed = "|".join(s.replace(".", r"\.") for s in sorted(suffixes, key=len, reverse=True)) or r"(?!)"
    return F.when(_address(bare), bare).otherwise(F.regexp_extract(bare, rf"(?:^|\.)({listed}|[^.]*)$", 1))


def domain(name: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The suffix and one label before it; a number address is its own domain."""
    bare, end = _bare(name), suffix(name, suffixes)
    before = bare.substr(F.lit(1), F.length(bare) - F.length(end) - 1)
    return F.when(F.length(bare) <= F.length(end) + 1, bare).otherwise(F.concat(F.substring_index(before, ".", -1), F.lit("."), end))


def _bare(name: Column) -> Column:
    return F.regexp_replace(name, r"(?s)^.*@|\.?(?::\d*)?$", "")


def _address(bare: Column) -> Column:
    return bare.rlike(r"^(?:\d+(?:\.\d+){3}|\[.*)$")


def rule(name: Column, place: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, else null."""
    hits = []
    for _, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        of, slash, rest = text.partition("/")
        fits = ((name == of) | name.endswith("." + of)) & place.startswith(slash + rest)
        hits.append(F.when(fits, F.lit(text)))
    return F.coalesce(*hits, F.lit(None).cast("string"))


def counted(pages: DataFrame, url: str = "url", bad: str = "bad", suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """``host``, ``domain``, ``suffix``, and ``n`` and ``k``: the pages whose ``bad`` is not null, and those
    where it is true.  Counts are combined before the shuffle, so a hot host is one row per task."""
    outcome = pages[bad]
    per_host = pages.select(host(pages[url]).alias("host"), outcome.alias("bad")).groupBy("host")
    df = per_host.agg(F.count("bad").alias("n"), F.count_if("bad").alias("k"))
    return df.select("host", domain(F.col("host"), suffixes).alias("domain"), suffix(F.col("host"), suffixes).alias("suffix"), "n", "k")


def strength(children: DataFrame, mean: str) -> float:
    """Of a level's beta-binomial prior, by moments: ``n``, ``k`` and the parent's ``mean`` per row.

    With correlation r between two pages of a child, ``n * (k / n - mean) ** 2`` is expected to be
    ``mean * (1 - mean) * (1 + (n - 1) * r)``; the sums over all children give r, and ``1 / r - 1``
    is the strength.  Children with at most one page in all say nothing: the strongest prior.
    """
    m, n, k = F.col(mean), F.col("n"), F.col("k")
    seen = children.where("n > 0").select(
        (n * (k / n - m) * (k / n - m)).alias("scatter"), (m * (1 - m)).alias("alone"), (m * (1 - m) * (n - 1)).alias("together")
    )
    row = seen.agg(*[F.sum(c).alias(c) for c in seen.columns]).first()
    if not row["together"]:
        return STRONGEST
    r = (row["scatter"] - row["alone"]) / row["together"]
    return STRONGEST if r <= 1 / (STRONGEST + 1) else max(WEAKEST, 1 / r - 1)


def reputation(pages: DataFrame, url: str = "url", bad: str = "bad", suffixes: Sequence[str] = SUFFIXES, bound: float = BOUND) -> DataFrame:
    """``host``, its outcomes ``n`` and ``k``, the posterior mean ``rate`` of its share of bad pages and the
    ``lower`` bound of that.

    Pages without an outcome name their host, which then has its domain's mean.  Null urls and those without
    ``://`` share the empty host.  Repeated rows count each.  Without any outcome all means are 0.5.
    """
    hosts = written(counted(pages, url, bad, suffixes))
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = hosts.groupBy("suffix", "domain").agg(*sums)
    tops = domains.groupBy("suffix").agg(*sums)
    total = tops.agg(*[F.coalesce(s, F.lit(0)).alias(c) for s, c in zip((F.sum("n"), F.sum("k")), "nk")]).first()
    df = tops.withColumn("above", F.lit((total["k"] + 0.5) / (total["n"] + 1.0)))
    for children, key in ((domains, "suffix"), (hosts.drop("suffix"), "domain")):
        df = df.withColumn("mean", _shrunk(strength(df, "above"))).select(key, F.col("mean").alias("above"))
        df = children.join(df, key)
    m = strength(df, "above")
    rate = _shrunk(m)
    spread = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + m + 1))
    return df.withColumn("rate", rate).select("host", "n", "k", "rate", (F.col("rate") - bound * spread).alias("lower"))


def _shrunk(m: float) -> Column:
    return (F.col("k") + F.lit(m) * F.col("above")) / (F.col("n") + F.lit(m))


def judged(
    pages: DataFrame, hosts: DataFrame, url: str = "url", rules: Sequence[tuple[str, str]] = RULES, limit: float = LIMIT, columns: list[str] | None = None
) -> DataFrame:
    """The input columns (or those named), ``host``, ``path``, ``rule``, ``verdict``, and the host's ``n``, ``k``, ``rate``
    and ``lower`` from its reputation.

    A host without a reputation is allowed.  Null urls have an empty host and path.  Result columns replace
    input columns of their name.  Spark broadcasts the reputations where they are small; else the join
    splits hot hosts at run time.
    """
    columns = pages.columns if columns is None else columns
    df = pages.select(packed(pages, columns=columns), host(pages[url]).alias("host"), path(pages[url]).alias("path"))
    known = hosts.select(F.col("host").alias("of"), "n", "k", "rate", "lower")
    df = df.join(known, df["host"] == known["of"], "left")
    df = df.withColumn("rule", rule(F.col("host"), F.col("path"), rules))
    by_rule = F.coalesce(*[F.when(F.col("rule") == text, F.lit(verdict)) for verdict, text in rules], F.lit(None).cast("string"))
    by_host = F.when(F.col("lower") > limit, "block").otherwise("allow")
    results = {c: F.col(c) for c in ("host", "path", "rule")} | {"verdict": F.coalesce(by_rule, by_host)}
    results |= {"n": F.coalesce("n", F.lit(0)), "k": F.coalesce("k", F.lit(0)), "rate": F.col("rate"), "lower": F.col("lower")}
    return unpacked(df, columns, results)
