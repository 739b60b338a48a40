"""N-gram Jaccard join by chosen paths.

A text is the set of its word shingles, in a sketch of TOKENS min-wise tokens.  In each of RUNS
runs all sets start together and are split DEPTH times: a path chooses each token position with
probability 1 / (similarity * TOKENS), and sets that share the chosen token go on together, so
that similar sets stay together about once in each step while others part.  Buckets are compared
by brute force; the runs are repeated until a pair at the threshold is met and found alike with
probability RECALL, 0.997, over all sketches that it may have.  Pairs that stand alone are lost
with the rest; in larger groups other links save them.

What the buckets find are candidate groups; inside them all pairs are compared exactly, on whole
sets.  Large buckets and groups are cut into blocks, and every pair of blocks is a task of its
own.  Equal sets are one node with the number of their documents, and only links that hold a group
together leave a task, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import written
from mailspark.llm.hashing import grams, groups, mixed, words

SHINGLE = 5
SIMILARITY = 0.8
TOKENS = 64
DEPTH = 3
RECALL = 0.997
BLOCK = 512

_FACTORS = mixed(np.arange(1, TOKENS + 1, dtype=np.uint64)) | np.uint64(1)


def agreeing(similarity: float) -> np.ndarray:
    """Probability of each number of agreeing tokens, 0 to TOKENS, in a pair at the threshold."""
    return np.array([math.comb(TOKENS, a) * similarity**a * (1 - similarity) ** (TOKENS - a) for a in range(TOKENS + 1)])


def least(similarity: float, recall: float = RECALL) -> int:
    """Agreeing tokens below which a pair is no candidate; a quarter of what may be lost at the
    threshold is lost here."""
    return int(np.searchsorted(np.cumsum(agreeing(similarity)), (1 - recall) / 4, side="right"))


def runs(similarity: float, depth: int = DEPTH, recall: float = RECALL) -> int:
    """Runs until a pair at the threshold has met, and is no less alike than ``least``, with
    probability ``recall``, averaged over the agreeing tokens: in a run a shared path survives
    ``depth`` steps of a branching process with one successor on average."""
    same = np.arange(TOKENS + 1)
    alive = np.ones(TOKENS + 1)
    for _ in range(depth):
        alive = 1 - (1 - alive / (similarity * TOKENS)) ** same
    weight = np.where(same >= least(similarity, recall), agreeing(similarity), 0)
    times = 1
    while weight @ (1 - (1 - alive) ** times) < recall:
        times += 1
    return times


# --- sets, in numpy ---------------------------------------------------------------------------


def sets(texts: list[bytes], shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle of its words,
    a text without words the empty set."""
    w = words(texts)
    h, at = grams(w, shingle)
    of, bounds = w.text[at], w.bounds()
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        own = np.unique(h[cuts[i] : cuts[i + 1]])
        if not len(own) and bounds[i + 1] > bounds[i]:
            value = np.zeros(1, np.uint64)
            for x in w.hash[bounds[i] : bounds[i + 1]]:
                value = mixed(value * np.uint64(3) + x)
            own = value
        out.append(own)
    return out


def set_key(own: np.ndarray) -> int:
    """A hash of the whole set."""
    total = np.array([np.add.reduce(mixed(own)) + np.uint64(len(own))], np.uint64)
    return int(mixed(total).view(np.int64)[0])


def sketches(many: list[np.ndarray]) -> np.ndarray:
    """A row of TOKENS minima per non-empty set."""
    starts = np.cumsum([0] + [len(s) for s in many[:-1]])
    every = mixed(np.concatenate(many))
    out = np.empty((len(many), TOKENS), np.uint16)
    for i, factor in enumerate(_FACTORS):
        least = np.minimum.reduceat((every * factor) >> np.uint64(16), starts)
        out[:, i] = mixed(least) & np.uint64(0xFFFF)
    return out


def leaves(sketch: np.ndarray, similarity: float, depth: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """Paths of every set after ``depth`` splits of ``times`` runs: number of the set, path."""
    limit = np.uint64(min(2**64 - 1, int(2**64 / (similarity * TOKENS))))
    n = len(sketch)
    of = np.tile(np.arange(n), times)
    path = mixed(np.repeat(np.arange(1, times + 1, dtype=np.uint64), n))
    places = mixed(np.arange(101, 101 + TOKENS, dtype=np.uint64))
    for _ in range(depth):
        row, place = np.nonzero(mixed(path[:, None] ^ places) < limit)
        path = mixed(path[row] * np.uint64(5) + places[place] + sketch[of[row], place])
        of = of[row]
    return of, path


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the least row it is linked with, over any number of links."""
    label = np.arange(n)
    while True:
        new = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def shared(many: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many elements each two of the sets have in common, exactly."""
    every = np.concatenate(many)
    of = np.repeat(np.arange(len(many)), [len(s) for s in many])
    _, column, count = np.unique(every, return_inverse=True, return_counts=True)
    rank = np.cumsum(count > 1) - 1
    keep = count[column] > 1
    of, column = of[keep], rank[column[keep]]
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    out = np.zeros((len(many), len(many)), np.float32)
    for start in range(0, int(rank[-1]) + 1 if len(rank) else 0, width):
        lo, hi = np.searchsorted(column, [start, start + width])
        m = np.zeros((len(many), width), np.float32)
        m[of[lo:hi], column[lo:hi] - start] = 1
        out += m @ m.T
    return out


# --- tables -----------------------------------------------------------------------------------


def nodes(docs: DataFrame, name: str, text: str) -> DataFrame:
    """``id``, ``set`` (a hash) and ``sketch`` of every document with an id and a word."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at, part in groups(batch["text"]):
                many = sets(part)
                full = [i for i, s in enumerate(many) if len(s)]
                if full:
                    sketch = sketches([many[i] for i in full])
                    ids = batch["id"].iloc[at : at + len(part)].iloc[full]
                    yield pd.DataFrame({"id": ids, "set": [set_key(many[i]) for i in full], "sketch": [s.tobytes() for s in sketch]})

    rows = docs.where(docs[name].isNotNull()).select(docs[name].cast("long").alias("id"), docs[text].alias("text"))
    return rows.mapInPandas(make, "id long, set long, sketch binary")


def blocks(rows: DataFrame, key: str, node: str, most: int = BLOCK) -> DataFrame:
    """``rows`` of keys with two nodes or more; a key of more than ``most`` is cut into blocks,
    and every pair of blocks becomes a group of its own (``key``, ``a``, ``b``, own block ``c``)."""
    sizes = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    rows = rows.join(sizes, key).withColumn("parts", F.ceil(F.col("n") / most).cast("int"))
    rows = rows.withColumn("c", F.pmod(F.xxhash64(node), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = rows.select("*", other.alias("o"))
    return rows.withColumn("a", F.least("c", "o")).withColumn("b", F.greatest("c", "o")).drop("o", "n", "parts")


def by_group(df: DataFrame, key: str, work: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame], schema: str, rows: int = 4096) -> DataFrame:
    """Apply ``work`` to whole groups (``key``, ``a``, ``b``), several at a time; a task holds a
    few groups of at most two blocks."""

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < rows:
                continue
            every = pd.concat(held, ignore_index=True)
            tags = every[[key, "a", "b"]].to_numpy()
            last = int(np.flatnonzero((tags != tags[-1]).any(1))[-1]) + 1 if (tags != tags[-1]).any() else 0
            held = [every.iloc[last:]]
            if last:
                yield work(every.iloc[:last].reset_index(drop=True), _tags(tags[:last]))
        if held and sum(map(len, held)):
            every = pd.concat(held, ignore_index=True)
            yield work(every, _tags(every[[key, "a", "b"]].to_numpy()))

    # By set inside a group: the least row of a component is its least set, in whatever group.
    return df.repartition(key, "a", "b").sortWithinPartitions(key, "a", "b", "set").mapInPandas(stream, schema)


def _tags(rows: np.ndarray) -> np.ndarray:
    """Numbers of the groups of sorted rows."""
    return np.cumsum(np.concatenate([[0], (rows[1:] != rows[:-1]).any(1)])) if len(rows) else np.zeros(0, int)


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it is connected with, from links ``u``, ``v``.

    Each round takes the least label of a node and its neighbours, then the label of that
    label; the rounds grow with the logarithm of the longest chain.  All in tables: every
    round is written to the shared folder.
    """
    both = written(links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u != v").distinct())
    labels = written(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("u"), F.min("v")).alias("root")))
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), "root"), "v").groupBy(F.col("u").alias("node")).agg(F.min("root").alias("near"))
        new = labels.join(near, "node").select("node", F.least("root", "near").alias("mid"), F.col("root").alias("old"))
        up = labels.select(F.col("node").alias("mid"), F.col("root").alias("top"))
        new = written(new.join(up, "mid", "left").select("node", F.least("mid", "top").alias("root"), "old"))
        labels = new.select("node", "root")
        if new.where("root != old").isEmpty():
            return labels


def near_links(found: DataFrame, similarity: float) -> DataFrame:
    """Links ``u``, ``v`` between sets that met in a bucket and whose sketches are alike."""
    times, enough = runs(similarity), least(similarity)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in filter(len, batches):
            sketch = np.frombuffer(b"".join(batch["sketch"]), np.uint16).reshape(len(batch), TOKENS)
            of, path = leaves(sketch, similarity, DEPTH, times)
            yield pd.DataFrame({"path": path.view(np.int64), "set": batch["set"].to_numpy()[of]})

    def compare(rows: pd.DataFrame, tag: np.ndarray) -> pd.DataFrame:
        sketch = np.frombuffer(b"".join(rows["sketch"]), np.uint16).reshape(len(rows), TOKENS)
        a, b = [np.zeros(0, int)], [np.zeros(0, int)]
        for step in range(1, int(np.bincount(tag).max())):
            at = np.flatnonzero(tag[step:] == tag[:-step])
            alike = (sketch[at] == sketch[at + step]).sum(1) >= enough
            a.append(at[alike])
            b.append(at[alike] + step)
        label = components(len(rows), np.concatenate(a), np.concatenate(b))
        at = np.flatnonzero(label != np.arange(len(rows)))
        node = rows["set"].to_numpy()
        return pd.DataFrame({"u": node[at], "v": node[label[at]]}).drop_duplicates()

    paths = found.mapInPandas(split, "path long, set long").distinct()
    met = blocks(paths, "path", "set").join(found, "set")
    return by_group(met, "path", compare, "u long, v long").distinct()


def joined(docs: DataFrame, name: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``id``, ``class_id`` (the least id of its class) and ``n_links`` of every document: with how
    many other documents it has at least ``similarity`` of their shingles in common.

    Classes are connected over any number of links.  Texts without words and documents without
    an id are linked with none.  Rows that share id and shingles are one document.
    """
    every = docs.select(docs[name].cast("long").alias("id"), docs[text].alias("text"))
    base = written(nodes(docs, name, text))
    members = base.select("id", "set").distinct()
    own = written(members.groupBy("set").agg(F.min("id").alias("least"), F.count("*").alias("copies")))
    found = written(base.groupBy("set").agg(F.first("sketch").alias("sketch")))
    candidates = connected(near_links(found, similarity)).withColumnRenamed("node", "set").withColumnRenamed("root", "around")
    wanted = written(candidates.join(own, "set"))

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at, part in groups(batch["text"]):
                rows = batch.iloc[at : at + len(part)]
                many = sets(part)
                fits = [i for i, s in enumerate(many) if len(s) and set_key(s) == rows["set"].iloc[i]]
                if fits:
                    yield rows.drop(columns="text").iloc[fits].assign(elements=[many[i].tobytes() for i in fits])

    # Always by shuffle: what is wanted grows with the input, and the plan is to be the same at every size.
    texts = every.join(wanted.withColumnRenamed("least", "id").hint("merge"), "id").select("set", "around", "copies", "text")
    held = texts.mapInPandas(whole, "set long, around long, copies long, elements binary").dropDuplicates(["set"])
    held = written(held)

    def compare(rows: pd.DataFrame, tag: np.ndarray) -> pd.DataFrame:
        out = []
        for _, group in rows.groupby(tag):
            many = [np.frombuffer(e, np.uint64) for e in group["elements"]]
            size = np.array([len(m) for m in many], np.float64)
            common = shared(many).astype(np.float64)
            alike = common >= similarity * (size[:, None] + size - common) - 1e-9
            np.fill_diagonal(alike, False)
            if group["a"].iloc[0] != group["b"].iloc[0]:  # inside the blocks others compare
                block = group["c"].to_numpy()
                alike &= block[:, None] != block
            label = components(len(many), *np.nonzero(alike))
            node = group["set"].to_numpy()
            out.append(pd.DataFrame({"set": node, "links": alike @ group["copies"].to_numpy(), "root": node[label]}))
        return pd.concat(out)

    cut = blocks(held.select("around", "set"), "around", "set").join(held.drop("around"), "set")
    compared = written(by_group(cut, "around", compare, "set long, links long, root long"))
    links = compared.groupBy("set").agg(F.sum("links").alias("links"))
    classes = connected(compared.select(F.col("set").alias("u"), F.col("root").alias("v")))
    sets_of = own.join(classes.withColumnRenamed("node", "set"), "set", "left").join(links, "set", "left")
    sets_of = written(sets_of.select("set", "least", "copies", F.coalesce("root", "set").alias("root"), F.coalesce("links", F.lit(0)).alias("links")))
    least = sets_of.groupBy("root").agg(F.min("least").alias("class_id"))
    result = members.join(sets_of.join(least, "root"), "set")
    result = result.select("id", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    rest = docs.select(docs[name].cast("long").alias("id"), has_word(docs[text]).alias("w")).where(F.col("id").isNull() | ~F.col("w"))
    return result.unionByName(rest.select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links")))


def has_word(text: Column) -> Column:
    return F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


def distinct(docs: DataFrame, name: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The documents without those that are linked with a class of a smaller id, in their own
    columns: one document of each class stays."""
    links = joined(docs, name, text, similarity)
    goes = links.where(F.col("id") != F.col("class_id")).select(F.col("id").alias(name)).distinct()
    with_id = docs.where(docs[name].isNotNull()).join(goes, name, "left_anti")
    return with_id.select(*docs.columns).unionByName(docs.where(docs[name].isNull()))
