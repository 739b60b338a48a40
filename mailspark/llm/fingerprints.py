"""Document fingerprints by one-permutation MinHash.

Each word shingle is hashed once; some of its bits choose a bin, the rest compete for the bin's
minimum.  Empty bins copy the first filled one in a probe order of their own, the same for all
documents, so that each filled bin is equally likely (optimal densification).  Of each bin's
minimum the low-order bits are kept, packed as hexadecimal digits.  Everything is a column
expression.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailspark.llm.common import packed, unpacked, words, written

SHINGLE = 5
BINS = 128
#: Hexadecimal digits kept of each bin's minimum: four bits each.
DIGITS = 2


def probes(bins: int) -> Column:
    """For every bin the order in which it looks for a filled one: itself, then the others by a
    hash of both numbers."""
    orders = [sorted(range(bins), key=lambda j: (j != i, hashlib.md5(f"{i},{j}".encode()).digest())) for i in range(bins)]
    return F.from_json(F.lit(str(orders)), "array<array<int>>")


def with_fingerprint(df: DataFrame, text: str, name: str, shingle: int = SHINGLE, bins: int = BINS, digits: int = DIGITS) -> DataFrame:
    """``df`` with column ``name``: ``bins * digits`` hexadecimal digits.

    A text of fewer words than a shingle is one shingle of all its words; null and empty texts
    are an empty shingle, and equal only to such.
    """
    w, h, m, b, v = (f"__{x}_{name}" for x in ("w", "h", "m", "b", "v"))
    width = (bins - 1).bit_length()
    if 1 << width != bins:
        raise ValueError("the number of bins must be a power of two")
    df = df.withColumn(w, words(F.col(text)))
    parts = ", ".join(f"{w}[i + {j}]" for j in range(shingle))
    many = f"transform(sequence(0, size({w}) - {shingle}), i -> xxhash64({parts}))"
    one = f"array(xxhash64(array_join({w}, ' ')))"
    df = df.withColumn(h, F.expr(f"sort_array(IF(size({w}) >= {shingle}, {many}, {one}))"))
    # The upper bits are the bin: sorting brings a bin's hashes together, the least one first.
    first = f"i = 0 OR shiftrightunsigned(x ^ get({h}, i - 1), {64 - width}) != 0"
    df = df.withColumn(m, F.expr(f"filter({h}, (x, i) -> {first})"))
    df = df.withColumn(b, F.expr(f"transform({m}, x -> CAST(shiftrightunsigned(x, {64 - width}) AS INT))"))
    df = df.withColumn(v, F.expr(f"transform({m}, x -> lpad(hex(x & {16**digits - 1}L), {digits}, '0'))"))

    def digits_of(probe: Column) -> Column:
        own = F.array_position(F.col(b), probe[0])
        lent = F.element_at(F.col(m), F.array_position(F.col(b), F.array_intersect(probe, F.col(b))[0]).cast("int"))
        # Hashed again with the bin, or bins that borrow from one would all agree by one chance.
        lent = F.lpad(F.hex(F.xxhash64(lent, probe[0]).bitwiseAND(16**digits - 1)), digits, "0")
        return F.when(own > 0, F.element_at(F.col(v), own.cast("int"))).otherwise(lent)

    return df.withColumn(name, F.lower(F.array_join(F.transform(probes(bins), digits_of), ""))).drop(w, h, m, b, v)


def likeness(a: Column, b: Column, bins: int = BINS, digits: int = DIGITS) -> Column:
    """Estimated Jaccard similarity: the share of equal bins, less what unequal minima agree in
    by chance; 0 to 1, null if either is null."""
    same = F.aggregate(F.sequence(F.lit(0), F.lit(bins - 1)), F.lit(0), lambda n, i: n + (F.substr(a, i * digits + 1, F.lit(digits)) == F.substr(b, i * digits + 1, F.lit(digits))).cast("int"))
    chance = 1.0 / 16**digits
    value = F.greatest(F.lit(0.0), (same / F.lit(bins) - chance) / (1 - chance))
    return F.when(a.isNotNull() & b.isNotNull(), value)


def fingerprinted(docs: DataFrame, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """The input columns (or those named) with ``fingerprint``, which replaces an input column of
    its name.  Equal texts have equal fingerprints."""
    columns = docs.columns if columns is None else columns
    df = with_fingerprint(docs.select(packed(docs), F.coalesce(docs[text], F.lit("")).alias("text")), "text", "f")
    return unpacked(df, columns, {"fingerprint": F.col("f")})


def successors(ids: DataFrame) -> DataFrame:
    """``id`` and ``next``: of each distinct id that is not null the next greater one, of the
    greatest the least.

    Ids are dealt into ranges and ordered in each; only the first ids of the ranges meet."""
    ids = ids.where(F.col("id").isNotNull()).distinct()
    dealt = written(ids.repartitionByRange("id").withColumn("range", F.spark_partition_id()))
    first = dealt.groupBy("range").agg(F.min("id").alias("first"))
    every = Window.partitionBy()
    after = F.coalesce(F.lead("first").over(Window.orderBy("range")), F.min("first").over(every))
    first = first.select("range", after.alias("after"))
    inside = F.lead("id").over(Window.partitionBy("range").orderBy("id"))
    return dealt.withColumn("inside", inside).join(F.broadcast(first), "range").select("id", F.coalesce("inside", "after").alias("next"))


def against_next(docs: DataFrame, name: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how alike they are.

    The edited text has the last quarter of its characters (rounded down) replaced by the first
    as many (or all) of the next document's, in the order of ids; after the last comes the
    first.  Columns: ``id``, ``text``, ``edited``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited`` and ``near_next``.

    A document without an id has no next one: its edited text is its text, ``near_next`` null.
    Of repeated ids the document with the least such beginning is the next one.  Null texts are empty.
    """
    every = docs.select(docs[name].alias("id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    base = with_fingerprint(every.where(F.col("id").isNotNull()), "text", "fingerprint")
    quarter = F.floor(F.length("text") / 4).cast("int")
    asked = every.select("id", quarter.alias("k")).distinct().join(successors(every.select("id")), "id")
    asked = asked.select(F.col("next").alias("id"), F.col("id").alias("asker"), "k")
    given = base.join(asked, "id").select("asker", "k", F.substr("text", F.lit(1), F.col("k")).alias("head"), F.col("fingerprint").alias("next_fingerprint"))
    given = given.repartition("asker").groupBy("asker", "k").agg(F.min(F.struct("head", "next_fingerprint")).alias("g"))
    # One entry per length: a condition on it in the join would keep the texts' exchange from being used twice.
    given = given.groupBy("asker").agg(F.collect_list(F.struct("k", "g")).alias("gs"))
    found = base.join(given, F.col("id") == F.col("asker")).withColumn("k", quarter)
    found = found.withColumn("g", F.filter("gs", lambda x: x["k"] == F.col("k"))[0]["g"])
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - F.col("k")), F.col("g.head"))
    found = found.select("id", "text", "fingerprint", edited.alias("edited"), F.col("g.next_fingerprint").alias("next_fingerprint"))
    alone = with_fingerprint(every.where(F.col("id").isNull()), "text", "fingerprint")
    alone = alone.select("id", "text", "fingerprint", F.col("text").alias("edited"), F.lit(None).cast("string").alias("next_fingerprint"))
    found = with_fingerprint(found.unionByName(alone), "edited", "edited_fingerprint")
    return found.select(
        "id", "text", "edited", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
