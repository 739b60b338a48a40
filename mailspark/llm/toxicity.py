"""Toxicity by classifier chains: linear models predict one category after another, each fed the
probabilities of the earlier categories.

Terms are words and their beginnings.  A bounded sample of labelled texts selects the terms that
lean on toxic texts and trains the models; the earlier probabilities that a later model is
trained with are out-of-fold predictions.  Every document is scored on its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import packed, unpacked, written
from mailspark.llm.hashing import groups, words

#: Labelled texts that are learnt from, at most: toxic ones of each category, and others.
TOXIC = 600
OTHER = 5_000
#: Beginnings of words, in bytes, that are terms of their own.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Terms that the models know, at most; the texts that must show one; how far it leans.
TERMS = 512
LEAST = 3
LEAN = 6.0
FOLDS = 5
#: Languages that are categories of their own, at most, the most frequent ones; toxic texts of all
#: others count in the last category alone.
LANGUAGES = 20
TOXIC_FROM = 0.5


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and beginnings, and the number of the text of each."""
    w = words(texts, lower=True)
    found = [(w.text, w.hash)]
    for n in BEGINNINGS:
        which, h = w.prefix(n)
        found.append((w.text[which], h))
    return np.concatenate([h for _, h in found]), np.concatenate([t for t, _ in found])


@dataclass(frozen=True)
class Linear:
    weights: np.ndarray
    bias: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def linear(x: np.ndarray, y: np.ndarray, l2: float = 1.0, rounds: int = 80) -> Linear:
    """Logistic regression with balanced classes, by accelerated gradient steps; where only one
    class was seen, that class."""
    if not len(y) or y.min() == y.max():
        return Linear(np.zeros(x.shape[1]), 5.0 if len(y) and y[0] else -5.0)
    n = np.array([max((y == 0).sum(), 1), max((y == 1).sum(), 1)], np.float64)
    c = (len(y) / 2 / n)[y.astype(int)].astype(np.float32)
    x1 = np.ones((len(x), x.shape[1] + 1), np.float32)
    x1[:, :-1] = x
    v = np.ones(x1.shape[1])
    for _ in range(20):  # the largest curvature bounds the step
        v = x1.T @ (c * (x1 @ v))
        norm = np.linalg.norm(v)
        v /= max(norm, 1e-12)
    step = 1 / (norm / 4 + l2)
    w = z = np.zeros(x1.shape[1])
    shrink = np.append(np.full(x.shape[1], l2), 1e-3)
    for i in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x1 @ z, -30, 30)))
        new = z - step * (x1.T @ (c * (p - y)) + shrink * z)
        z = new + i / (i + 3) * (new - w)
        w = new
    return Linear(w[:-1], float(w[-1]))


@dataclass(frozen=True)
class Chain:
    known: np.ndarray
    categories: tuple[str, ...]
    models: tuple[Linear, ...]

    def counts(self, texts: list[bytes]) -> np.ndarray:
        """log(1 + count) of each known term in each text."""
        h, text = terms(texts)
        some = np.zeros(1 << 16, bool)
        some[self.known >> np.uint64(48)] = True
        near = np.flatnonzero(some[h >> np.uint64(48)])
        h, text = h[near], text[near]
        at = np.minimum(np.searchsorted(self.known, h), max(len(self.known) - 1, 0))
        hit = self.known[at] == h if len(self.known) else np.zeros(0, bool)
        n, k = len(texts), len(self.known)
        return np.log1p(np.bincount(text[hit] * k + at[hit], minlength=n * k).reshape(n, k))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of all categories, in the order of the chain."""
        for model in self.models:
            x = np.hstack([x, model.predict(x)[:, None]])
        return x[:, x.shape[1] - len(self.models) :]


def fit(ids: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray, categories: tuple[str, ...], folds: int = FOLDS) -> Chain:
    """A chain from the distinct terms of each text with their counts and a 0/1 row of labels.

    The last category stands for toxicity as a whole and selects the terms: those in at least
    LEAST toxic texts that are LEAN times as frequent there as in others.
    """
    toxic = labels[:, -1].astype(bool) if len(ids) else np.zeros(0, bool)
    none = np.zeros(0, np.uint64)
    every, n_toxic = np.unique(np.concatenate([i for i, t in zip(ids, toxic) if t] or [none]), return_counts=True)
    others, n_other = np.unique(np.concatenate([i for i, t in zip(ids, toxic) if not t] or [none]), return_counts=True)
    at = np.minimum(np.searchsorted(others, every), max(len(others) - 1, 0))
    n_clean = np.where(others[at] == every, n_other[at], 0) if len(others) else np.zeros(len(every))
    known = leaning(every, n_toxic, n_clean, toxic)
    return trained(known, [found_of(known, own, n) for own, n in zip(ids, counts)], labels, categories, folds)


def leaning(every: np.ndarray, n_toxic: np.ndarray, n_clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """The terms that a chain knows, of ascending ones with the numbers of toxic and other texts of each."""
    lean = (n_toxic + 0.1) / (toxic.sum() + 1) / ((n_clean + 0.5) / ((~toxic).sum() + 1))
    good = np.flatnonzero((n_toxic >= LEAST) & (lean >= LEAN))
    good = good[np.argsort(-n_toxic[good] * np.log(lean[good]), kind="stable")[:TERMS]]
    return np.sort(every[good])


def found_of(known: np.ndarray, own: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the known terms in a text and how often it has them."""
    _, at, here = np.intersect1d(known, own, assume_unique=True, return_indices=True)
    return at, n[here]


def trained(known: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, categories: tuple[str, ...], folds: int = FOLDS) -> Chain:
    """A chain from the known terms of each text."""
    k = len(known)
    x = np.zeros((len(found), k + len(categories)))  # one table: known terms, then the probabilities of one category after another
    for i, (at, n) in enumerate(found):
        x[i, at] = np.log1p(n)
    fold, models = np.arange(len(x)) % folds, []
    for j in range(len(categories)):
        y, unseen = labels[:, j].astype(np.float64), x[:, : k + j]
        models.append(linear(unseen, y))
        for f in range(folds):
            out = fold == f
            x[out, k + j] = linear(unseen[~out], y[~out]).predict(unseen[out]) if out.any() and (~out).any() else 0.5
    return Chain(known, categories, tuple(models))


def sample(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], name: str = "doc_id", text: str = "text", toxic: int = TOXIC, other: int = OTHER) -> DataFrame:
    """``text`` and ``labels`` array<int> of a bounded sample: up to ``toxic`` texts of each
    category and ``other`` texts of none, by a hash of their ids.  ``categories`` are
    conditions over the columns of ``doc`` and ``label``, a row of each table; the last stands for
    toxicity as a whole.
    """
    both = docs.select(docs[name].alias("__name"), packed(docs, "doc", [c for c in docs.columns if c != text]), docs[text].alias("__text"))
    known = labels.select(labels[name].alias("__name"), packed(labels, "label")).dropDuplicates(["__name"])
    marks = F.array(*[F.coalesce(c, F.lit(False)).cast("int") for c in categories.values()])
    narrow = both.drop("__text").join(known, "__name").select("__name", marks.alias("labels"))
    size = len(categories)
    parts = [narrow.where(F.col("labels")[j] == 1).orderBy(F.xxhash64("__name"), "__name").limit(toxic) for j in range(size)]
    parts.append(narrow.where(F.array_max("labels") == 0).orderBy(F.xxhash64("__name"), "__name").limit(other))
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.unionByName(part)
    chosen = chosen.dropDuplicates(["__name"])  # at most size * toxic + other rows
    found = both.select("__name", F.col("__text").alias("text")).join(F.broadcast(chosen), "__name")
    return found.orderBy(F.xxhash64("__name", "text")).limit(size * toxic + other).select("text", "labels")


def learnt(texts: DataFrame, categories: tuple[str, ...]) -> Chain:
    """A chain from ``text`` and ``labels`` of a bounded sample.  Terms are found and counted in tasks; the driver
    sees the counts of those in LEAST toxic texts, and of each text the terms that the models know."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at, part in groups(batch["text"]):
                h, text = terms(part)
                own = [np.unique(h[text == i], return_counts=True) for i in range(len(part))]
                columns = {"ids": [i.tobytes() for i, _ in own], "counts": [n.astype(np.int64).tobytes() for _, n in own]}
                yield pd.DataFrame(columns | {"labels": batch["labels"].iloc[at : at + len(part)].tolist()})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in filter(len, batches):
            toxic = np.array([row[-1] == 1 for row in batch["labels"]])
            sides = [np.unique(np.frombuffer(b"".join(batch["ids"][side]), np.int64), return_counts=True) for side in (toxic, ~toxic)]
            for (own, n), name, rest in zip(sides, ("n_toxic", "n_other"), ("n_other", "n_toxic")):
                yield pd.DataFrame({"id": own, name: n, rest: 0})[["id", "n_toxic", "n_other"]]

    def known_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in filter(len, batches):
            own = [found_of(shared.value, np.frombuffer(i, np.uint64), np.frombuffer(n, np.int64)) for i, n in zip(batch["ids"], batch["counts"])]
            yield pd.DataFrame({"at": [at.astype(np.uint16).tobytes() for at, _ in own], "n": [n.astype(np.uint32).tobytes() for _, n in own], "labels": batch["labels"].tolist()})

    found = written(texts.mapInPandas(find, "ids binary, counts binary, labels array<int>"))  # a bounded sample
    counted = found.mapInPandas(count, "id long, n_toxic long, n_other long").groupBy("id").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_other").alias("n_other"))
    toxic = np.array([r["toxic"] for r in found.select(F.element_at("labels", -1).alias("toxic")).collect()], bool)
    lean = (F.col("n_toxic") + 0.1) / float(toxic.sum() + 1) / ((F.col("n_other") + 0.5) / float((~toxic).sum() + 1))
    often = counted.where((F.col("n_toxic") >= LEAST) & (lean >= 0.999 * LEAN)).toPandas()  # a little more than ``leaning`` takes
    every = often["id"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(every)
    known = leaning(every[order], often["n_toxic"].to_numpy(np.int64)[order], often["n_other"].to_numpy(np.int64)[order], toxic)
    shared = found.sparkSession.sparkContext.broadcast(known)
    rows = found.orderBy("ids", "counts", "labels").mapInPandas(known_of, "at binary, n binary, labels array<int>").collect()
    rng = np.random.default_rng(11).permutation(len(rows))  # folds must not follow the order
    rows = [rows[i] for i in rng]
    labels = np.array([r["labels"] for r in rows], np.int64).reshape(len(rows), len(categories))
    return trained(known, [(np.frombuffer(r["at"], np.uint16), np.frombuffer(r["n"], np.uint32)) for r in rows], labels, categories)


def scored(docs: DataFrame, chain: Chain, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """The input columns (or those named) with ``categories`` map<string, double>, ``score`` (the
    last category) and ``toxic``.

    Null and empty texts have no terms and get the models' base probabilities, below
    TOXIC_FROM wherever toxic terms are rare.  Equal texts score alike.  Result columns
    replace input columns of their name.
    """
    columns = docs.columns if columns is None else columns
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    @F.pandas_udf("array<double>")
    def predict(texts: pd.Series) -> pd.Series:
        return pd.Series([p for _, part in groups(texts) for p in shared.value.predict(shared.value.counts(part))])

    df = docs.select(packed(docs), predict(docs[text]).alias("p"))
    names = F.array(*[F.lit(c) for c in chain.categories])
    score = F.element_at("p", -1)
    return unpacked(df, columns, {"categories": F.map_from_arrays(names, F.col("p")), "score": score, "toxic": score >= TOXIC_FROM})


def by_language(docs: DataFrame, labels: DataFrame, name: str = "doc_id", lang: str = "lang", label: str = "toxic", most: int = LANGUAGES) -> dict[str, Column]:
    """Categories where only one label is given: toxic in each language with toxic labels, the
    ``most`` frequent ones, then toxic at all."""
    marked = labels.where(labels[label] == 1).select(labels[name].alias("name")).distinct()
    found = docs.select(docs[name].alias("name"), docs[lang].alias("lang")).join(marked, "name").where("lang IS NOT NULL").groupBy("lang").count()
    langs = sorted(r["lang"] for r in found.orderBy(F.desc("count"), "lang").limit(most).collect())
    is_toxic = F.col("label").getField(label) == 1
    return {f"{label}_{x}": is_toxic & (F.col("doc").getField(lang) == x) for x in langs} | {label: is_toxic}
