"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets whole epochs of its documents first; the rest of its budget is filled in the
order of exponential keys scaled by the documents' quality weights (``u ** (1 / weight)``, the
largest first), prefix-summed until the next document does not fit; a few later documents that
fit the remainder best close the gap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailspark.llm.common import narrowed, packed, unpacked, words, written

#: Weights of the sources in code point order, repeating.
WEIGHTS = (1.0, 2.0, 3.0)
MAX_EPOCHS = 3
#: Documents of a source that share one bucket of keys, about: the rows one task ranks.
PER_BUCKET = 4096
#: Documents that close the gap after the ranked ones.
FITS = 4
#: Sources whose decisions are sent to every task.
SMALL = 100_000
SYMBOLS = r"[#*$%&|<>]"


def quality_weight(text: Column, size: Column) -> Column:
    """Between 0 and 1: texts with many symbols for their words come later."""
    return (size + 1) / (size + 1 + F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS)))


def priority(name: Column, weight: Column) -> Column:
    """The sampling key of a document: 0 to 1, drawn from a hash of its name, so that reruns
    agree.  Weights that are null or not above 0 come after all others, below 0."""
    u = (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") + 1) / F.lit(float(2**52))
    return F.when(weight > 0, F.pow(u, 1 / weight)).otherwise(u - 2)


def targets(totals: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """``totals`` (source, source_size) with ``target``: shares of the whole by weight; what is
    above ``most`` times a source's size goes to the others by weight, until none is above.

    One row per source, so the windows over all sources are small.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    df = totals.withColumn("place", F.row_number().over(by_name))
    df = df.withColumn("share", F.element_at(cycle, ((F.col("place") - 1) % len(weights) + 1).cast("int")))
    df = df.withColumn("cap", (F.col("source_size") * most).cast("double")).withColumn("full_at", F.col("cap") / F.col("share"))
    before = Window.orderBy("full_at", "place").rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    df = df.select(
        "*",
        (F.sum(F.col("source_size").cast("double")).over(everyone) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).alias("left"),
        (F.sum("share").over(everyone) - F.coalesce(F.sum("share").over(before), F.lit(0.0))).alias("shares"),
    )
    df = df.withColumn("level", F.col("left") / F.col("shares"))
    df = df.withColumn("level", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "place", "level"))).over(everyone)["level"])
    return df.select("source", "source_size", F.least("cap", F.col("share") * F.col("level")).alias("target"))


def decisions(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """One row per source from ``sizes`` (source, size, priority): ``source_size``, ``target``,
    ``epochs``, and what the last, partial epoch takes: all keys in buckets above
    ``cut_bucket``, in it those from ``cut`` on, and the keys ``fits``.

    A hot source is ranked in many buckets: sums per bucket are prefix-summed, and only the
    bucket in which the budget ends is ranked by key.  Equal keys count as one.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    plan = targets(totals.select("source", "source_size"), weights, most)
    plan = plan.join(totals.select(F.col("source").alias("s"), F.ceil(F.col("n") / PER_BUCKET).alias("buckets")), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = written(plan.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")))

    def of(df: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
        other = other.withColumnRenamed("source", "s")
        return df.join(other, F.col("source").eqNullSafe(F.col("s")), how).drop("s")

    keys = sizes.groupBy("source", "priority").agg(F.sum("size").alias("size"))
    keys = written(of(keys, plan.select("source", "buckets", "budget")).withColumn("bucket", bucket()))
    upward = Window.partitionBy("source").orderBy(F.col("bucket").desc())
    sums = keys.groupBy("source", "bucket", "budget").agg(F.sum("size").alias("size"))
    sums = sums.withColumn("upto", F.sum("size").over(upward))
    ends = sums.where(F.col("upto") > F.col("budget")).groupBy("source").agg(F.max(F.struct("bucket", (F.col("upto") - F.col("size")).alias("before"))).alias("e"))
    ends = ends.select("source", F.col("e.bucket").alias("cut_bucket"), F.col("e.before").alias("before"))
    inside = of(keys, ends).where(F.col("bucket") == F.col("cut_bucket"))
    inside = inside.withColumn("upto", F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy(F.col("priority").desc())))
    fits = F.col("upto") <= F.col("budget")
    cuts = inside.groupBy("source", "cut_bucket", "budget").agg(
        F.min(F.when(fits, F.col("priority"))).alias("cut"), F.coalesce(F.max(F.when(fits, F.col("upto"))), F.min("before")).alias("filled")
    )
    cuts = written(cuts.withColumn("gap", F.col("budget") - F.col("filled")).drop("budget", "filled"))
    plan = of(plan, cuts, "left").withColumn("fits", F.array().cast("array<double>"))
    for _ in range(FITS):
        rest = of(keys.drop("buckets", "budget"), plan.select("source", "cut_bucket", "cut", "gap", "fits")).where(~taken_in_part())
        off = F.abs(F.col("size") - F.col("gap"))
        best = rest.where(off < F.col("gap")).groupBy("source").agg(F.max_by(F.struct("priority", "size"), F.struct(-off, F.col("priority"))).alias("best"))
        plan = of(plan, best, "left")
        found = F.col("best").isNotNull()
        plan = plan.withColumn("fits", F.when(found, F.array_append("fits", F.col("best.priority"))).otherwise(F.col("fits")))
        plan = written(plan.withColumn("gap", F.when(found, F.col("gap") - F.col("best.size")).otherwise(F.col("gap"))).drop("best"))
    return plan.drop("budget", "gap")


def bucket() -> Column:
    return F.floor(F.col("priority") * F.col("buckets"))


def in_last_epoch() -> Column:
    """Among the leading keys of the source, which all fit."""
    at = F.coalesce(F.col("bucket") == F.col("cut_bucket"), F.lit(False))
    return F.coalesce(F.col("bucket") > F.col("cut_bucket"), F.lit(False)) | (at & F.coalesce(F.col("priority") >= F.col("cut"), F.lit(False)))


def taken_in_part() -> Column:
    """In the source's last, partial epoch."""
    return in_last_epoch() | F.coalesce(F.array_contains("fits", F.col("priority")), F.lit(False))


def weighed(docs: DataFrame, name: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``row`` (the input columns), ``source``, ``size`` in words and ``priority``."""
    size = F.size(words(docs[text])).cast("long")
    df = docs.select(packed(docs), docs[source].cast("string").alias("source"), docs[text].alias("text"), F.coalesce(docs[name].cast("string"), docs[text], F.lit("")).alias("name"), size.alias("size"))
    return df.select("row", "source", "size", priority(F.col("name"), quality_weight(F.col("text"), F.col("size"))).alias("priority"))


def mix(docs: DataFrame, columns: list[str] | None = None, name: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """The input columns (or those named) with ``size``, ``source_size``, ``target`` and
    ``times``: how often the mix takes the document.

    Null texts have no words.  A null source is a source, after all others.  Repeated rows
    have equal keys and are taken alike.  Result columns replace input columns of their name.
    """
    columns = docs.columns if columns is None else columns
    df = weighed(docs, name, text, source)
    sizes = written(df.select("source", "size", "priority"))
    plan = decisions(sizes, weights, most).withColumnRenamed("source", "s")
    if plan.count() <= SMALL:  # a row per source, counted; beyond, a hot source is left to the runtime skew join
        plan = F.broadcast(plan)
    df = df.select(narrowed(columns), "source", "size", "priority")
    df = df.join(plan, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("bucket", bucket())
    results = {"size": F.col("size"), "source_size": F.col("source_size"), "target": F.col("target"), "times": F.col("epochs") + taken_in_part().cast("long")}
    return unpacked(df, columns, results)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as many times as it is taken, in its own columns."""
    df = mix(docs.withColumn("__row", packed(docs)), ["__row"], **options)
    df = df.where("times > 0").select("__row", F.explode(F.expr("sequence(1L, times)")))
    return df.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])
