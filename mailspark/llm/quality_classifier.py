"""Quality by nearest-neighbour voting in a latent-semantic space.

Terms are what a text looks like: trigrams of character kinds, word lengths, and repetitions.
A bounded sample of labelled texts gives the space (truncated singular value decomposition) and
the labelled vectors, which are broadcast; every document is compared with all of them by exact
cosine products in blocks, and its nearest neighbours' labels are weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import packed, unpacked
from mailspark.llm.hashing import grams, groups, words

#: Labelled texts of each label that the space is fitted on and that vote.
SAMPLE = 2_000
RANK = 48
NEIGHBOURS = 15
#: Steps of a vector's components.  Cosines are sums of multiples of 1 / GRID ** 2 below 2, thus exact
#: in 32-bit floats: they do not depend on the block that a text is in.
GRID = 2048
#: Similarity to this power weights a neighbour.
SHARPNESS = 8
#: From this score on a text counts as good.
GOOD = 0.3

# Kinds of bytes; lead bytes of UTF-8 are left out, so that a letter beyond ASCII counts once.
_KINDS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r\x0b\x0c", ".", ",", "!?", ";:", "'\"()-", "|", "#*$%&@^~+=_\\/`", "<>[]{}"]
_OTHER, _EDGE = len(_KINDS), len(_KINDS) + 1
_N = _EDGE + 1
_SKIP = 255
_KIND = np.full(256, _OTHER, np.uint8)
for _k, _chars in enumerate(_KINDS):
    _KIND[list(_chars.encode())] = _k
_KIND[0xC0:] = _SKIP
_KIND[0x80:0x9F], _KIND[0x9F:0xC0] = 1, 0
_LENGTHS = 8
_REPEATS = 6
TERMS = _N**3 + _LENGTHS + _REPEATS


def term_shares(texts: list[bytes]) -> np.ndarray:
    """A row per text: the share of each trigram among the text's trigrams, of each word length
    and repetition among its words."""
    n = len(texts)
    raw = np.frombuffer(b"\xff".join([b"", *texts, b""]), np.uint8)  # 0xFF is in no UTF-8 text
    kind = _KIND[raw]
    edge = raw == 0xFF
    kind[edge] = _EDGE
    keep = kind != _SKIP
    kind, text = kind[keep].astype(np.int32), np.cumsum(edge)[keep] - 1
    tri = (kind[:-2] * _N + kind[1:-1]) * _N + kind[2:]
    at = np.flatnonzero(kind[1:-1] != _EDGE)
    out = np.zeros((n, TERMS), np.float32)
    out[:, : _N**3] = np.bincount(text[1:-1][at] * _N**3 + tri[at], minlength=n * _N**3).reshape(n, -1)
    out[:, : _N**3] /= np.maximum(out[:, : _N**3].sum(1, keepdims=True), 1)

    w = words(texts)
    total = np.maximum(np.bincount(w.text, minlength=n), 1)[:, None]
    size = np.searchsorted([2, 3, 4, 6, 9, 13, 21], w.length, side="right")
    out[:, _N**3 : _N**3 + _LENGTHS] = np.bincount(w.text * _LENGTHS + size, minlength=n * _LENGTHS).reshape(n, -1) / total
    for j, (h, at) in enumerate([(w.hash, np.arange(len(w.hash))), grams(w, 2), grams(w, 3), grams(w, 8)]):
        of = w.text[at]
        order = np.lexsort((h, of))
        again = np.zeros(len(h), bool)
        again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (of[order[1:]] == of[order[:-1]])
        out[:, _N**3 + _LENGTHS + j] = np.bincount(of[again], minlength=n) / total[:, 0]
    for j, step in ((4, 1), (5, 2)):
        same = np.flatnonzero((w.hash[step:] == w.hash[:-step]) & (w.text[step:] == w.text[:-step]))
        out[:, _N**3 + _LENGTHS + j] = np.bincount(w.text[same], minlength=n) / total[:, 0]
    return np.sqrt(out)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def place(self, shares: np.ndarray) -> np.ndarray:
        """Vectors of length one, in steps of 1 / GRID."""
        v = (shares.astype(np.float64) * self.weights) @ self.axes.astype(np.float64)
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        return (np.rint(v * GRID) / GRID).astype(np.float32)

    def score(self, texts: list[bytes], block: int = 512) -> np.ndarray:
        """Between 0 and 1 for every text; 0.5 where there is no labelled text at all."""
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        out = []
        for i in range(0, len(texts), block):
            near = self.place(term_shares(texts[i : i + block])) @ self.vectors.T
            n = near.shape[1]
            k = min(NEIGHBOURS, n)
            rank = np.arange(n) - (near.astype(np.float64) * GRID**2).astype(np.int64) * n  # ties: the earlier row
            best = np.sort(np.argpartition(rank, k - 1, axis=1)[:, :k], axis=1)
            weight = np.maximum(np.take_along_axis(near, best, 1), 1e-3).astype(np.float64) ** SHARPNESS
            out.append((weight * self.labels[best]).sum(1) / weight.sum(1))
        return np.concatenate(out) if out else np.zeros(0)


def fit(shares: np.ndarray, labels: np.ndarray, rank: int = RANK) -> Model:
    """Weights that even out the terms, and the leading axes by randomised iteration."""
    weights = 1 / (shares.std(0) + 0.02) if len(shares) else np.ones(TERMS)
    weights = weights.astype(np.float32)
    x = shares * weights
    g = np.random.default_rng(7).standard_normal((x.shape[0], rank + 16)).astype(np.float32)
    q = x.T @ g
    for _ in range(4):
        q, _ = np.linalg.qr(q)
        q = x.T @ (x @ q)
    q, _ = np.linalg.qr(q)
    small = x @ q
    _, _, v = np.linalg.svd(small.T @ small)
    axes = (q @ v.T)[:, :rank].astype(np.float32)
    model = Model(weights, axes, np.zeros((0, axes.shape[1]), np.float32), labels.astype(np.float64))
    return Model(weights, axes, model.place(shares), labels.astype(np.float64))


def held_out(name: Column) -> Column:
    """Documents that no label may be learnt from; those without an id are among them."""
    return F.coalesce(F.crc32(name.cast("string")) % 5 == 0, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, label: str, name: str = "doc_id", text: str = "text", most: int = SAMPLE) -> DataFrame:
    """Up to ``most`` labelled texts of each label, chosen by a hash of their ids, as ``text``
    and ``label``.  Repeated labels of a document count as their least; null labels do not."""
    known = labels.where(F.col(label).isNotNull() & ~held_out(F.col(name))).groupBy(name).agg(F.min(label).cast("int").alias("__label"))
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("__label") == value).orderBy(F.xxhash64(name), name).limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = chosen.select(F.col(name).alias("__name"), "__label")
    found = docs.select(docs[name].alias("__name"), docs[text].alias("text")).join(F.broadcast(chosen), "__name")  # at most 2 * most rows
    found = found.select(F.xxhash64("__name", "text").alias("tie"), "text", F.col("__label").alias("label"))
    return found.orderBy("tie").limit(2 * most).select("text", "label")


def learnt(texts: DataFrame) -> Model:
    """A model from ``text`` and ``label`` of a bounded sample; terms are counted in tasks."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at, part in groups(batch["text"]):
                rows = term_shares(part)
                ids = [np.flatnonzero(r).astype(np.int32) for r in rows]
                yield pd.DataFrame({
                    "ids": [i.tobytes() for i in ids], "shares": [r[i].tobytes() for r, i in zip(rows, ids)],
                    "label": batch["label"].iloc[at : at + len(part)].to_numpy(),
                })

    rows = texts.mapInPandas(count, "ids binary, shares binary, label int").collect()  # a bounded sample
    rows.sort(key=lambda r: (bytes(r["ids"]), bytes(r["shares"]), r["label"]))
    x = np.zeros((len(rows), TERMS), np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["ids"], np.int32)] = np.frombuffer(r["shares"], np.float32)
    return fit(x, np.array([r["label"] for r in rows], np.int64))


def scored(docs: DataFrame, model: Model, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """The input columns (or those named) with ``score`` and ``predicted``.

    Null and empty texts are scored as texts without terms.  Equal texts have equal scores, and
    of labelled texts that are equally near the earlier ones vote.
    Result columns replace input columns of their name.
    """
    columns = docs.columns if columns is None else columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        parts = [shared.value.score(part) for _, part in groups(texts)]
        return pd.Series(np.concatenate(parts) if parts else [], dtype="float64")

    df = docs.select(packed(docs), score(docs[text]).alias("score"))
    return unpacked(df, columns, {"score": F.col("score"), "predicted": (F.col("score") >= GOOD).cast("int")})
