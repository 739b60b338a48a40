"""Byte-level BPE encoding and decoding.

A text is cut into pieces by the pattern of the vocabulary, and each piece is merged by rank.
Long texts are cut into overlapping chunks whose pieces are found in parallel; where two
neighbours have a piece border in common they are in step from there on, because a match
depends only on what follows its start.  Decoding joins the bytes of the ids.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import packed, unpacked

#: Characters of a chunk, and those it shares with the next.
CHUNK = 65_536
OVERLAP = 1_024
#: The pattern looks no further than this beyond a piece ("'re" after "'", a blank's successor).
MARGIN = 3
#: Texts between certain borders that a worker keeps with their ids.
CACHED = 40_000
#: Before a blank that a visible character follows there is always a border.
_BLANK = re.compile(r" (?=\S)")


@lru_cache(maxsize=2)
def tokens(path: str) -> list[bytes | None]:
    """The bytes of each rank; all that decoding needs."""
    with open(path, "rb") as lines:
        ranks = [(base64.b64decode(token), int(rank)) for token, rank in map(bytes.split, lines)]
    out: list[bytes | None] = [None] * (max(rank for _, rank in ranks) + 1)
    for token, rank in ranks:
        out[rank] = token
    return out


def joined(ids: np.ndarray, path: str) -> bytes:
    """The bytes that ids stand for."""
    return b"".join(map(tokens(path).__getitem__, ids.tolist()))


class Coder:
    """A vocabulary of ranks with its pattern."""

    def __init__(self, path: str, pattern: str, cached: int = CACHED):
        import regex
        import tiktoken

        self.ranks = {token: rank for rank, token in enumerate(tokens(path)) if token is not None}
        self.pattern = regex.compile(pattern)
        self.merges = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.known = _Known(self.packed_ids, cached)

    def piece(self, piece: str) -> list[int]:
        """Ids of one piece: itself if it is a token, else merged by rank."""
        raw = piece.encode("utf-8", "replace")
        rank = self.ranks.get(raw)
        return [rank] if rank is not None else self.merges._core_bpe.encode_single_piece(raw)

    def packed_ids(self, text: str) -> bytes:
        ids = [i for piece in self.pattern.findall(text) for i in self.piece(piece)]
        return array("i", ids).tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text: stretches between certain borders recur, so their ids are kept."""
        first, *rest = _BLANK.split(text)
        get = self.known.__getitem__
        return np.frombuffer(get(first) + b"".join(map(get, map(" ".__add__, rest))), np.int32)

    def ends(self, text: str) -> np.ndarray:
        """Where the pieces end."""
        return np.fromiter((m.end() for m in self.pattern.finditer(text)), np.int32)


class _Known(dict):
    def __init__(self, make: Callable[[str], bytes], most: int):
        self.make, self.most = make, most

    def __missing__(self, text: str) -> bytes:
        value = self.make(text)
        if len(text) < 64:
            if len(self) >= self.most:
                self.clear()
            self[text] = value
        return value


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


def stitched(texts: list[str], ends: list[np.ndarray], step: int, match: Callable[[str, int], int]) -> Iterator[tuple[int, int]]:
    """Pieces (start, end) of the whole text from the ends found in its chunks.

    ``texts`` start every ``step`` characters.  Pieces that end within MARGIN of a chunk's end
    might be other ones in the whole text and do not count, except in the last chunk.  From the border reached, pieces of the chunk
    are taken until the next chunk has the border too.  Where no chunk has it, ``match``
    finds the next piece in the whole text, until one does.
    """
    borders = [set((k * step + e).tolist()) | ({0} if k == 0 else set()) for k, e in enumerate(ends)]
    trusted = []
    for k, e in enumerate(ends):
        last = k + 1 == len(ends)
        trusted.append([x for x in (k * step + e).tolist() if last or x <= k * step + len(texts[k]) - MARGIN])
    total = (len(texts) - 1) * step + len(texts[-1])
    whole, at = None, 0
    while at < total:
        here = min(at // step, len(texts) - 1)
        for k in range(here, max(here - 2, -1), -1):
            i = bisect_right(trusted[k], at)
            if at in borders[k] and i < len(trusted[k]):
                break
        else:
            whole = whole or "".join(t[:step] for t in texts[:-1]) + texts[-1]
            end = match(whole, at)
            yield at, end
            at = end
            continue
        while i < len(trusted[k]):
            yield at, trusted[k][i]
            at, i = trusted[k][i], i + 1
            if at >= (k + 1) * step and k + 1 < len(texts) and at in borders[k + 1]:
                break


def encoded(docs: DataFrame, path: str, pattern: str, text: str = "text", columns: list[str] | None = None, chunk: int = CHUNK, overlap: int = OVERLAP, decode: bool = False, digest: bool = False) -> DataFrame:
    """The input columns (or those named) with ``ids`` array<int>, for every whole text; with
    ``decode`` also ``raw``, the bytes that these ids stand for, with ``digest`` only their ``raw_sha256``
    (lowercase hex), so that no decoded text leaves its task.

    Null and empty texts have no ids.  Repeated rows stay; a long text that many rows share is
    encoded once.  A result column replaces an input column of its name.
    """
    columns = docs.columns if columns is None else columns

    names = ["ids"] + ["raw"] * decode + ["raw_sha256"] * digest
    kinds = {"ids": "array<int>", "raw": "binary", "raw_sha256": "string"}
    fields = ", ".join(f"{n} {kinds[n]}" for n in names)

    def made(ids: list[np.ndarray]) -> list[pa.Array]:
        """Columns of ``names``; the ids of all texts lie in one array."""
        ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
        columns = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)])))]
        if decode:
            columns.append(pa.array([joined(i, path) for i in ids], pa.binary()))
        if digest:
            columns.append(pa.array([hashlib.sha256(joined(i, path)).hexdigest() for i in ids], pa.string()))
        return columns

    @F.arrow_udf(fields)
    def ids_of(texts: pa.Array) -> pa.Array:
        c = coder(path, pattern)
        return pa.StructArray.from_arrays(made([c.encode(t.as_py()) for t in texts]), names)

    df = docs.select(packed(docs), F.coalesce(docs[text], F.lit("")).alias("text"))
    short = df.where(F.length("text") <= chunk)
    short = unpacked(short.withColumn("e", ids_of("text")), columns, {c: F.col("e").getField(c) for c in names})

    long = df.where(F.length("text") > chunk).withColumn("key", F.sha2("text", 256))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, t in zip(batch["key"], batch["text"]):
                for k, start in enumerate(range(0, len(t), chunk)):
                    yield pd.DataFrame({"key": [key], "place": [k], "text": [t[start : start + chunk + overlap]]})

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["ends"] = [coder(path, pattern).ends(t).tobytes() for t in batch["text"]]
            yield batch

    def join(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("place").sort_values("place")
        c, texts = coder(path, pattern), group["text"].tolist()
        ends = [np.frombuffer(e, np.int32) for e in group["ends"]]
        parts = []
        for start, end in stitched(texts, ends, chunk, lambda t, at: c.pattern.match(t, at).end()):
            k = min(start // chunk, len(texts) - 1)
            piece = texts[k][start - k * chunk : end - k * chunk]
            while len(piece) < end - start:  # a piece longer than what the chunk shares
                k += 1
                piece += texts[k][start + len(piece) - k * chunk : end - k * chunk]
            parts.append(c.known[piece])
        columns = made([np.frombuffer(b"".join(parts), np.int32)])
        return pd.DataFrame({"key": [group["key"].iloc[0]]} | {n: c.to_pylist() for n, c in zip(names, columns)})

    chunks = long.select("key", "text").dropDuplicates(["key"]).mapInPandas(cut, "key string, place int, text string")
    chunks = chunks.repartition("key", "place").mapInPandas(pieces, "key string, place int, text string, ends binary")
    ids = chunks.groupBy("key").applyInPandas(join, f"key string, {fields}")
    long = unpacked(long.join(ids, "key"), columns, {c: F.col(c) for c in names})
    return short.unionByName(long)


def decoded(ids: Column, path: str) -> Column:
    """The bytes of an array of ids; null for null."""

    @F.pandas_udf("binary")
    def bytes_of(arrays: pd.Series) -> pd.Series:
        return pd.Series([None if a is None else joined(np.asarray(a), path) for a in arrays])

    return bytes_of(ids)
