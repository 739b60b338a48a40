"""Line dedup by winnowing over line hashes.

A run is LINES consecutive lines with a word (blank lines do not count), or one line of LONG
characters or more.  Runs that also stand earlier, in a document with a smaller id or further up in the
same one, are deleted.  Of each window of LINES lines the least hash is a fingerprint, so every
repeated run shows one; positions of fingerprints that recur are joined, matches are extended to
both sides over the lines around them, and what was found to be repeated goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import SPACE, packed, unpacked, written

LINES = 2
#: Characters (code points) from which on a single line is a run.
LONG = 40
#: A run with more than one in so many of all fingerprints is hot: there are fewer such runs than this
#: number, and each is dealt over SALTS partitions.
HOT, SALTS = 1_000, 32


def fingerprints(docs: DataFrame, name: str, text: str, lines: int, long: int) -> DataFrame:
    """``id`` and ``tie`` (a hash of the text: rows with one id may have several), the fingerprint ``mark``, and around each selected line the lines that a window
    with it can hold: ``near`` array<struct<no, hash>>, with ``at``, its place in them."""
    own = F.split(F.coalesce(docs[text], F.lit("")), "\n", -1)
    df = docs.where(docs[name].isNotNull()).select(docs[name].alias("id"), F.xxhash64(docs[text]).alias("tie"), F.transform(own, lambda x, i: F.struct(i.alias("no"), x.alias("line"))).alias("l"))
    df = df.withColumn("l", F.filter("l", lambda x: x["line"].rlike(SPACE.replace("[", "[^"))))
    df = df.withColumn("l", F.transform("l", lambda x: F.struct(x["no"].alias("no"), F.xxhash64(x["line"]).alias("hash"), (F.length(x["line"]) >= long).alias("long"))))
    least = "array_min(transform(slice(l, {0} + 1, {1}), (y, j) -> struct(y.hash, -j AS j)))"
    windows = f"IF(size(l) >= {lines}, transform(sequence(0, size(l) - {lines}), s -> CAST(s - {least.format('s', lines)}.j AS INT)), CAST(array() AS array<int>))"
    long_ones = "transform(filter(transform(l, (x, i) -> struct(x.long, i AS i)), x -> x.long), x -> x.i)"
    df = df.withColumn("picked", F.expr(f"array_union({windows}, {long_ones})"))
    near = f"slice(l, greatest(at - {lines - 1}, 0) + 1, least(at, {lines - 1}) + {lines})"
    # Outer: else the optimizer asks first whether there is anything to explode, by working all of it out.
    df = df.select("id", "tie", "l", F.explode_outer("picked").alias("at")).where("at IS NOT NULL")
    return df.select("id", "tie", F.expr("l[at].hash").alias("mark"), F.expr(near).alias("near"), F.expr(f"least(at, {lines - 1})").alias("at"))


def repeated(docs: DataFrame, name: str = "doc_id", text: str = "text", lines: int = LINES, long: int = LONG) -> DataFrame:
    """``id`` and the numbers of its lines to delete, ``gone`` array<int>.

    Fingerprints that occur once are dropped first; then, for each run around a fingerprint, its
    first position among all is found by a combined minimum, and every later one is a match.
    Neighbouring matches make up the longest repeated run.
    """
    marks = written(fingerprints(docs, name, text, lines, long))
    total = marks.count()
    recur = marks.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark")
    marks = marks.join(recur, "mark", "left_semi")
    # Extended to both sides: all windows of the lines around that hold the fingerprint.
    spans = f"transform(filter(sequence(0, at), s -> s + {lines} <= size(near) AND s + {lines} > at), s -> slice(near, s + 1, {lines}))"
    spans = f"concat({spans}, IF(near[at].long, array(slice(near, at + 1, 1)), CAST(array() AS array<array<struct<no: int, hash: bigint, long: boolean>>>)))"
    runs = marks.select("id", "tie", F.explode(F.expr(spans)).alias("run"))
    runs = runs.select("id", "tie", F.expr("run[0].no").alias("no"), F.expr("transform(run, x -> x.no)").alias("nos"), F.xxhash64(F.size("run"), F.expr("transform(run, x -> x.hash)")).alias("key")).distinct()
    at = F.struct("id", "tie", "no")
    first = written(runs.groupBy("key").agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1"))
    hot = first.where(F.col("n") > total // HOT).select("key", F.lit(True).alias("hot"))
    first = first.join(F.broadcast(hot), "key", "left").select("key", "first", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("id", "tie", "no"), F.lit(SALTS)).cast("int")).otherwise(0)
    runs = runs.join(F.broadcast(hot), "key", "left").withColumn("salt", salt).drop("hot")
    later = runs.join(first, ["key", "salt"]).where(at > F.col("first"))
    return later.select("id", "tie", F.explode("nos").alias("no")).groupBy("id", "tie").agg(F.collect_set("no").alias("gone"))


def deduplicated(docs: DataFrame, name: str = "doc_id", text: str = "text", lines: int = LINES, long: int = LONG) -> DataFrame:
    """The input columns with repeated runs cut from ``text``, and ``__lines`` and ``__gone``, how
    many lines there were and how many went; these two replace input columns of their name.

    Lines compare as they are.  Null and empty texts stay; so do documents without an id, which
    take no part.  Equal rows count as one document; rows with the same id and different texts are
    different documents, in the order of a hash of their texts.
    """
    gone = repeated(docs, name, text, lines, long)
    df = docs.select(packed(docs), docs[name].alias("of"), F.xxhash64(docs[text]).alias("hash"), docs[text].alias("text"))
    left = df.where("of IS NOT NULL").join(gone, (F.col("of") == gone["id"]) & (F.col("hash") == gone["tie"]), "left").select("row", "text", "gone")
    rest = df.where("of IS NULL").select("row", "text", F.lit(None).cast("array<int>").alias("gone"))
    df = left.unionByName(rest).withColumn("own", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    keep = F.array_except(F.sequence(F.lit(0), F.size("own") - 1), "gone")
    cut = F.array_join(F.transform(keep, lambda i: F.get("own", i)), "\n")
    results = {text: F.when(F.col("gone").isNull(), F.col("text")).otherwise(cut), "__lines": F.size("own"), "__gone": F.coalesce(F.size("gone"), F.lit(0))}
    out = unpacked(df, docs.columns, results)
    return out.select(*[c for c in docs.columns if c not in ("__lines", "__gone")], "__lines", "__gone")
