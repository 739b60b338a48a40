"""Substring dedup with an FM-index per shard.

A window is WINDOW consecutive words.  A word goes if a window over it also starts in a document
with a smaller id.

Every window has an anchor, the word group with the least hash in it; equal windows have equal
anchors.  Only stretches around anchors that two documents show can hold such a window.  These
stretches are dealt into shards by anchor; equal ones become one with the least document; the
rest is indexed (wavelet matrix over the Burrows-Wheeler transform, the suffix order is not kept)
and streamed against the index: backward search gives the matching statistics, and each interval
of WINDOW words or more tells the least document that it starts in.

Stretches around frequent anchors go the same way, but equal ones are combined before they are
dealt, so that a shard gets the different ones only, and what the index finds goes back to the
documents by a salted join.  An anchor with very many different stretches is cut further, into
its windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import written
from mailspark.llm.hashing import grams, groups, words

WINDOW = 13
#: Words of an anchor.
ANCHOR = 4
#: Stretches of an anchor, from which on equal ones are combined before they are dealt to shards.
FREQUENT = 2_000
#: Different stretches of a frequent anchor, from which on it is cut into its windows.
DIFFERENT = 2_000
#: Words that are indexed together, about.
INDEXED = 100_000
#: Tasks over which the documents of a frequent stretch are spread (bits of a mask).
SALTS = 32
#: Bytes of a word's hash that stand for it in a shard.
SYMBOL = 6


class FMIndex:
    """Occurrences of word sequences of up to 16 words in an array of symbols 1, 2, ...; a 0 ends
    each stretch.  ``borders`` are those, in the order of suffixes, of suffixes that agree in
    ``size`` words (9 to 16), and ``least`` the least of ``docs`` (one per symbol) between them."""

    def __init__(self, symbols: np.ndarray, docs: np.ndarray, size: int):
        n = len(symbols)
        rank = eighth = symbols.astype(np.int64)
        for step in (1, 2, 4, 8):
            if step == 8:
                eighth = rank
            ahead = np.zeros(n, np.int64)
            ahead[: n - step] = rank[step:] + 1
            pair = rank * (int(ahead.max(initial=0)) + 1) + ahead
            order = np.argsort(pair)
            rank = np.zeros(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], pair[order][1:] != pair[order][:-1]]))
        ahead = np.zeros(n, np.int64)
        ahead[: n - (size - 8)] = eighth[size - 8 :] + 1
        a, b = eighth[order], ahead[order]
        self.borders = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        self.least = np.minimum.reduceat(docs[order], self.borders)
        self.size = n
        self.levels = max(1, int(symbols.max(initial=1)).bit_length())
        level = symbols[order - 1]  # the Burrows-Wheeler transform
        self.bits, self.ones, self.zeros = [], [], []
        for shift in range(self.levels - 1, -1, -1):
            bit = (level >> shift & 1).astype(bool)
            packed = np.packbits(np.append(bit, np.zeros(-n % 64 + 64, bool)), bitorder="little").view("<u8")
            self.bits.append(packed)
            self.ones.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]).astype(np.int32))
            self.zeros.append(n - int(bit.sum()))
            level = np.concatenate([level[~bit], level[bit]])
        every = np.arange(1 << self.levels)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=len(every)))])
        self.shift = self.first[:-1] - self.occurrences(every, np.zeros_like(every))

    def occurrences(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position of the transform, plus its start in
        the last level: differences of two are counts."""
        at = upto
        for i, shift in enumerate(range(self.levels - 1, -1, -1)):
            word, rest = at >> 6, (at & 63).astype(np.uint64)
            one = self.ones[i][word] + np.bitwise_count(self.bits[i][word] & ((np.uint64(1) << rest) - np.uint64(1)))
            at = np.where(symbol >> shift & 1, self.zeros[i] + one, at - one)
        return at

    def extended(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of suffixes with one more word in front."""
        both = self.occurrences(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        shift = self.shift[symbol]
        return shift + both[: len(lo)], shift + both[len(lo) :]


def least_documents(symbols: np.ndarray, lengths: np.ndarray, docs: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """For each window of each stretch the least of ``docs`` in whose stretches it occurs.

    The stretches' symbols lie end to end.  All stretches are searched side by side, from their
    ends: the last window word by word, each earlier one by one more word in front and one less
    behind (the interval of all suffixes that agree in ``size`` words).
    """
    _, ids = np.unique(symbols, return_inverse=True)
    starts = np.cumsum(lengths + 1) - lengths - 1
    text = np.zeros(int((lengths + 1).sum()), np.int64)
    inside = np.ones(len(text), bool)
    inside[starts + lengths] = False
    text[inside] = ids + 1
    index = FMIndex(text, np.repeat(docs, lengths + 1), size)
    borders, ends = index.borders, np.append(index.borders[1:], index.size)

    windows = lengths - size + 1
    found = np.empty(int(windows.sum()), np.int64)
    slot = np.cumsum(windows) - 1  # of each stretch's last window
    at = starts + lengths - 1
    lo, hi = index.first[text[at]], index.first[text[at] + 1]
    for _ in range(size - 1):
        at = at - 1
        lo, hi = index.extended(text[at], lo, hi)
    while len(at):
        group = np.searchsorted(borders, lo, side="right") - 1
        found[slot] = index.least[group]
        more = windows > 1
        windows, group, at, slot = windows[more] - 1, group[more], at[more] - 1, slot[more] - 1
        lo, hi = index.extended(text[at], borders[group], ends[group])
    return found


# --- stretches around anchors ---------------------------------------------------------------


def anchors(texts: list[bytes], size: int = WINDOW, length: int = ANCHOR):
    """Words of the texts; the anchor of each window (the first of equal ones) by its hash and the
    number of its first word; and the number of the window's first word."""
    w = words(texts)
    h, at = grams(w, length)
    every = np.full(len(w.hash) + 1, np.iinfo(np.uint64).max, np.uint64)
    every[at] = h
    n = max(len(w.text) - size + 1, 0)
    best, ahead = every[:n], np.zeros(n, np.int8)
    for i in range(1, size - length + 1):
        other = every[i : n + i]
        ahead[other < best] = i
        best = np.minimum(best, other)
    windows = np.flatnonzero(w.text[:n] == w.text[size - 1 :])
    return w, best[windows].view(np.int64), windows + ahead[windows], windows


def runs(place: np.ndarray) -> np.ndarray:
    """Where a stretch of windows with one anchor begins."""
    return np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else np.zeros(0, np.int64)


def among(values: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which of the values are names; there is one name at least."""
    names = np.sort(names)
    return names[np.minimum(np.searchsorted(names, values), len(names) - 1)] == values


def suspects(docs: DataFrame, name: str, text: str, size: int = WINDOW) -> DataFrame:
    """Stretches of words around anchors that two documents show: ``anchor``, whether it is
    ``frequent``, ``id`` and ``tie`` (a hash of the text) of the document, the number of the first
    word, the ``words`` as symbols, and ``uid``, a hash of them."""
    every = docs.where(docs[name].isNotNull()).select(docs[name].cast("long").alias("id"), F.xxhash64(docs[text]).alias("tie"), F.coalesce(docs[text], F.lit("")).alias("text"))

    def marks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, part in groups(batch["text"]):
                w, best, place, windows = anchors(part, size)
                run = runs(place)
                best, text = best[run], w.text[windows[run]]
                order = np.lexsort((best, text))
                best, text = best[order], text[order]
                once = np.ones(len(best), bool)
                once[1:] = (best[1:] != best[:-1]) | (text[1:] != text[:-1])
                rows, at = first + text[once], np.flatnonzero(once)
                yield pd.DataFrame({
                    "anchor": best[once], "id": batch["id"].to_numpy()[rows], "tie": batch["tie"].to_numpy()[rows],
                    "n": np.diff(np.append(at, len(once))).astype(np.int32),
                })

    shown = every.mapInPandas(marks, "anchor long, id long, tie long, n int")
    often = shown.groupBy("anchor").agg(F.count("*").alias("docs"), F.sum("n").alias("all")).where("docs > 1").select("anchor", (F.col("all") > FREQUENT).alias("frequent"))
    wanted = shown.join(often, "anchor").groupBy("id", "tie").agg(F.collect_list("anchor").alias("anchors"), F.collect_list(F.expr("IF(frequent, anchor, NULL)")).alias("often"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, part in groups(batch["text"]):
                w, best, place, windows = anchors(part, size)
                begin, end = runs(place), np.append(runs(place)[1:], len(place))
                text = w.text[windows[begin]]
                # Which stretches are wanted: their text's anchors, as one sorted list per text.
                kind = np.full(len(begin), -1)
                cuts = np.searchsorted(text, np.arange(len(part) + 1))
                for i in range(len(part)):
                    own = best[begin[cuts[i] : cuts[i + 1]]]
                    kind[cuts[i] : cuts[i + 1]] += among(own, batch["anchors"].iloc[first + i])
                    if len(batch["often"].iloc[first + i]):
                        kind[cuts[i] : cuts[i + 1]] += among(own, batch["often"].iloc[first + i])
                which = np.flatnonzero(kind >= 0)
                lo, hi = windows[begin[which]], windows[end[which] - 1] + size
                symbol = (w.hash & np.uint64((1 << 8 * SYMBOL) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SYMBOL].tobytes()
                rows = first + w.text[lo]
                if len(lo):
                    yield pd.DataFrame({
                        "anchor": best[begin[which]], "frequent": kind[which] == 1, "id": batch["id"].to_numpy()[rows], "tie": batch["tie"].to_numpy()[rows],
                        "start": lo - w.bounds()[w.text[lo]],
                        "words": [symbol[a:b] for a, b in zip((lo * SYMBOL).tolist(), (hi * SYMBOL).tolist())],
                    })

    found = every.join(wanted, ["id", "tie"]).mapInPandas(cut, "anchor long, frequent boolean, id long, tie long, start int, words binary")
    return found.withColumn("uid", F.xxhash64("words"))


def shards(batches: Iterator, lengths: Callable = lambda rows: rows["words"].str.len(), cut: Callable = lambda rows, a, b: rows.iloc[a:b], join: Callable = partial(pd.concat, ignore_index=True)) -> Iterator:
    """Rows in order of anchor, whole anchors at a time, about INDEXED words together; how batches of the kind at hand (pandas')
    tell the bytes of their words, are cut and joined."""
    held: list = []
    weight, last = 0, None
    for batch in batches:
        # Anchors' ends in the batch, and the words up to them.
        names = np.asarray(batch["anchor"])
        sums = np.cumsum(np.asarray(lengths(batch))) // SYMBOL
        begin = 0
        while begin < len(names):
            before = int(sums[begin - 1]) if begin else 0
            end = int(np.searchsorted(sums, before + INDEXED - weight)) + 1 if weight < INDEXED else begin
            if held and weight >= INDEXED and names[begin] != last:
                yield join(held)
                held, weight = [], 0
                continue
            # On to the end of the anchor at hand.
            end = min(max(end, begin + 1), len(names))
            other = np.flatnonzero(names[end:] != names[end - 1])
            end = end + int(other[0]) if len(other) else len(names)
            held.append(cut(batch, begin, end))
            weight, last = weight + int(sums[end - 1]) - before, names[end - 1]
            begin = end
    if held:
        yield join(held)


def indexed(words: pa.Array, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least documents of the windows of all different stretches, end to end; of each stretch the
    first of its windows there, and their number."""
    coded = words.cast(pa.large_binary()).dictionary_encode()
    same, different = coded.indices.to_numpy(), coded.dictionary
    low = np.full(len(different), np.iinfo(np.int64).max)
    np.minimum.at(low, same, ids)
    bounds = np.frombuffer(different.buffers()[1], np.int64)[: len(different) + 1]
    raw = np.frombuffer(different.buffers()[2], np.uint8)[: bounds[-1]].reshape(-1, SYMBOL)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :SYMBOL] = raw
    lengths = np.diff(bounds) // SYMBOL
    windows = lengths - size + 1
    least = least_documents(wide.view("<u8").ravel(), lengths, low, size)
    return least, (np.cumsum(windows) - windows)[same], windows[same]


def search(batches: Iterator[pa.RecordBatch], size: int = WINDOW) -> Iterator[pa.RecordBatch]:
    """Of the stretches' documents, the windows that also start in one with a smaller id."""
    lengths, cut = lambda rows: pc.binary_length(rows["words"]), lambda rows, a, b: rows.slice(a, b - a)
    for rows in shards(batches, lengths, cut, lambda held: pa.Table.from_batches(held).combine_chunks()):
        ids, tie, start, words = (rows[name].chunk(0) for name in ("id", "tie", "start", "words"))
        ids, start = ids.to_numpy(), start.to_numpy()
        least, first, windows = indexed(words, ids, size)
        of = np.repeat(np.arange(len(ids)), windows)
        step = np.arange(len(of)) - (np.cumsum(windows) - windows)[of]
        hit = np.flatnonzero(least[first[of] + step] < ids[of])
        if len(hit):
            place = (start[of[hit]] + step[hit]).astype(np.int32)
            cuts = np.flatnonzero(np.concatenate([[True], of[hit][1:] != of[hit][:-1]]))
            own = of[hit][cuts]
            hits = pa.ListArray.from_arrays(pa.array(np.append(cuts, len(hit)).astype(np.int32)), pa.array(place))
            yield pa.RecordBatch.from_arrays([pa.array(ids[own]), tie.take(pa.array(own)), hits], ["id", "tie", "hits"])


def search_combined(batches: Iterator[pd.DataFrame], size: int = WINDOW) -> Iterator[pd.DataFrame]:
    """Of stretches with their least and greatest document, the least document of each window;
    only those that count against one of the stretch's documents."""
    for rows in shards(batches):
        least, first, windows = indexed(pa.array(rows["words"], pa.large_binary()), rows["low"].to_numpy(np.int64), size)
        each = [least[a : a + n] for a, n in zip(first.tolist(), windows.tolist())]
        late = np.array([x.min() for x in each]) < rows["high"].to_numpy(np.int64)
        if late.any():
            yield pd.DataFrame({
                "anchor": rows["anchor"][late], "uid": rows["uid"][late], "salts": rows["salts"][late],
                "least": pd.Series(each, dtype=object)[late],
            })


def frequent_hits(stretches: DataFrame, size: int = WINDOW) -> DataFrame:
    """``id``, ``tie`` and ``hits`` of stretches around frequent anchors.

    Equal stretches are one row with their least and greatest document before they meet in a
    shard.  An anchor with more than DIFFERENT of them is cut into its windows, each a stretch and
    an anchor by itself.  A stretch goes back to its documents once for each salt that they have.
    """
    span, step = size * SYMBOL, F.col("at") * SYMBOL
    salted = stretches.withColumn("salt", F.pmod(F.xxhash64("id", "tie"), F.lit(SALTS)).cast("int"))
    bounds = [F.min("low").alias("low"), F.max("high").alias("high"), F.bit_or("salts").alias("salts")]
    one = salted.select("anchor", "words", F.col("id").alias("low"), F.col("id").alias("high"), F.expr("shiftleft(1L, salt)").alias("salts"))
    whole = written(one.groupBy("anchor", "words").agg(*bounds))
    wide = written(whole.groupBy("anchor").count().where(F.col("count") > DIFFERENT).select("anchor"))

    def cut(df: DataFrame) -> DataFrame:
        at = F.explode(F.sequence(F.lit(0), ((F.length("words") - span) / SYMBOL).cast("int"))).alias("at")
        df = df.join(wide, "anchor", "left_semi").select("*", at)
        df = df.withColumn("words", F.substring("words", step + 1, F.lit(span)))
        return df.withColumn("anchor", F.xxhash64("words")).withColumn("uid", F.col("anchor"))

    single = cut(whole).groupBy("anchor", "words").agg(*bounds)
    pieces = whole.join(wide, "anchor", "left_anti").unionByName(single).withColumn("uid", F.xxhash64("words"))
    pieces = pieces.repartition("anchor").sortWithinPartitions("anchor")
    least = pieces.mapInPandas(search_combined, "anchor long, uid long, salts long, least array<long>")
    salts = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.expr("salts").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i)) != 0)
    least = least.select("anchor", "uid", F.explode(salts).alias("salt"), "least")

    columns = ["anchor", "uid", "salt", "id", "tie", "start"]
    places = cut(salted).withColumn("start", F.col("start") + F.col("at")).select(columns)
    places = salted.join(wide, "anchor", "left_anti").select(columns).unionByName(places)
    hits = "transform(filter(sequence(0, size(least) - 1), j -> least[j] < id), j -> start + j)"
    return places.join(least, ["anchor", "uid", "salt"]).select("id", "tie", F.expr(hits).alias("hits")).where(F.size("hits") > 0)


def deduplicated(docs: DataFrame, name: str = "doc_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """``id``, ``text`` (the kept words joined by a blank), ``n_words`` and ``n_removed``.

    ``name`` is a column of integers.  Null and empty texts have no words.  Documents without an
    id keep all and take no part.  Windows of equal ids do not count against each other.
    """
    stretches = written(suspects(docs, name, text, size))
    rare = stretches.where("NOT frequent").select("anchor", "id", "tie", "start", "words")
    hits = rare.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(search, "id long, tie long, hits array<int>")
    late = frequent_hits(stretches.where("frequent"), size)
    gone = hits.unionByName(late).groupBy("id", "tie").agg(F.flatten(F.collect_list("hits")).alias("hits"))
    gone = gone.select(F.col("id").alias("own"), F.col("tie").alias("own_tie"), "hits")

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, n, removed = [], [], []
            for t, hits in zip(batch["text"], batch["hits"]):
                own = t.encode().split()  # of bytes, at the very signs of SPACE
                n.append(len(own))
                if hits is None or not len(hits):
                    out.append(b" ".join(own).decode())
                    removed.append(0)
                    continue
                change = np.zeros(len(own) + 1, np.int64)
                starts = np.unique(np.asarray(hits))
                change[starts] += 1
                change[starts + size] -= 1
                stay = np.cumsum(change)[:-1] == 0
                out.append(b" ".join(compress(own, stay.tolist())).decode())
                removed.append(len(own) - int(stay.sum()))
            yield pd.DataFrame({"id": batch["id"], "text": out, "n_words": n, "n_removed": removed})

    every = docs.select(docs[name].cast("long").alias("id"), F.xxhash64(docs[text]).alias("tie"), F.coalesce(docs[text], F.lit("")).alias("text"))
    known = every.where("id IS NOT NULL").join(gone, (F.col("id") == F.col("own")) & (F.col("tie") == F.col("own_tie")), "left").select("id", "text", "hits")
    alone = every.where("id IS NULL").select("id", "text", F.lit(None).cast("array<int>").alias("hits"))
    schema = "id long, text string, n_words long, n_removed long"
    return known.mapInPandas(kept, schema).unionByName(alone.mapInPandas(kept, schema))
