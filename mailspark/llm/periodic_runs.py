"""Periodic runs of words, found by block convolution.

A run is a stretch of words with smallest period q, at least ``least`` words and ``times * q`` long, that
no neighbouring word extends.  For each dyadic scale B the texts are cut into blocks of B words.  A run
with B <= q < 2B repeats several blocks q words further on, so each block is looked for in the window
that follows it: the sums of squared differences of word numbers at all B distances come from one
number-theoretic transform, in integers modulo a prime.  A zero marks an occurrence; chains of
neighbouring blocks with the same distance are compared word by word and extended to both sides.

Blocks that cannot matter are not transformed: those with a word that does not come back within the
window, and those deep inside a run found at a smaller scale (all their distances are multiples of its
period).  Rows are independent; batches are cut by bytes, and nothing crosses a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import packed, unpacked

LEAST, TIMES = 6, 4
#: A prime with 2 ** 30 | PRIME - 1 and products below 2 ** 64, and a generator of its units.
PRIME, GENERATOR = 3 * 2**30 + 1, 5
_P = np.uint64(PRIME)
#: Bytes of texts, and cells of a transform, taken on at once.
GROUP, CELLS = 4_000_000, 2**19
_RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


@lru_cache(maxsize=64)
def _roots(size: int, inverse: bool) -> np.ndarray:
    """Powers 0 .. size / 2 of a root of unity of order ``size``."""
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    root = pow(root, PRIME - 2, PRIME) if inverse else root
    out, n = np.ones(max(size // 2, 1), np.uint64), 1
    while n < len(out):
        out[n : 2 * n] = out[:n] * np.uint64(pow(root, n, PRIME)) % _P
        n *= 2
    return out


def transformed(rows: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of each row (a power of two long), values below PRIME; the inverse
    is not divided by the length.  Natural order in and out (Stockham's scheme, no bit reversal)."""
    m, size = rows.shape
    x, half, width = rows.reshape(m, 1, size), size // 2, 1
    while half:
        w = _roots(2 * half, inverse)[:, None] if half > 1 else np.ones((1, 1), np.uint64)
        y = x.reshape(m, 2, half, width)
        a, b = y[:, 0], y[:, 1]
        out = np.empty((m, half, 2, width), np.uint64)
        total = a + b
        out[:, :, 0] = total - _P * (total >= _P)
        out[:, :, 1] = (a + (_P - b)) % _P * w % _P
        x, half, width = out, half // 2, width * 2
    return x.reshape(m, size)


def mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sum of squared differences (mod PRIME) of each row's block with the stretches of its window that begin at
    0 .. B - 1; windows are 2B - 1 long and padded by one."""
    b = blocks.shape[1]
    padded = np.zeros_like(windows)
    padded[:, 0] = blocks[:, 0]
    padded[:, b + 1 :] = blocks[:, :0:-1]  # reversed in a circle: the product of transforms is then the correlation
    product = transformed(padded) * transformed(windows) % _P
    cross = transformed(product, inverse=True)[:, :b] * np.uint64(pow(2 * b, PRIME - 2, PRIME)) % _P
    squares = np.zeros((len(windows), 2 * b + 1), np.uint64)
    np.cumsum(windows * windows % _P, axis=1, out=squares[:, 1:])
    of_window = (squares[:, b : 2 * b] - squares[:, :b]) % _P
    of_block = (blocks * blocks % _P).sum(1, dtype=np.uint64)[:, None] % _P
    return (of_block + of_window + (_P - cross) * np.uint64(2)) % _P


def _numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    """All words as numbers from 1, end to end; where texts begin (and the end); the words themselves."""
    known: dict[bytes, int] = {}
    cut = [t.split() for t in texts]  # bytes.split() cuts at the six ASCII white space characters
    number = known.setdefault
    ids = [number(w, len(known) + 1) for words in cut for w in words]
    return np.array(ids, np.int64), np.concatenate([[0], np.cumsum([len(c) for c in cut])]).astype(np.int64), cut


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... count[0] of them, then those of first[1], ..."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - count), count)


def _returns(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Distance to the next equal word of the same text, or a very large number."""
    out = np.full(len(ids), 2**62, np.int64)
    if len(ids):
        order = np.sort((ids << 32) + np.arange(len(ids))) & (2**32 - 1)  # by word, then position
        text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[order]
        same = (ids[order[1:]] == ids[order[:-1]]) & (text[1:] == text[:-1])
        out[order[:-1][same]] = np.diff(order)[same]
    return out


class _Found:
    """Runs so far, by scale, in positions over all texts.

    Two runs of one scale overlap by less than the shorter of them (else they would be one run), so
    that ordered by start they are also ordered by end, and few of them cover a place.
    """

    def __init__(self):
        self.scales: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        if len(start):
            rows = np.unique(np.stack([start, end, period], 1), axis=0)
            self.scales.append((rows[:, 0], rows[:, 1], rows[:, 2]))

    def holds(self, begin: np.ndarray, stop: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
        """Which stretches lie in a run whose period divides ``of`` (any run where None)."""
        out = np.zeros(len(begin), bool)
        for start, end, period in self.scales:
            todo = np.flatnonzero(~out)
            at = np.searchsorted(start, begin[todo], side="right") - 1
            while len(todo):
                reach = (at >= 0) & (end[at] >= stop[todo])
                todo, at = todo[reach], at[reach]
                hit = np.ones(len(todo), bool) if of is None else of[todo] % period[at] == 0
                out[todo[hit]] = True
                todo, at = todo[~hit], at[~hit] - 1
        return out

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end, period, by start, then period."""
        if not self.scales:
            return (np.zeros(0, np.int64),) * 3
        start, end, period = (np.concatenate(x) for x in zip(*self.scales))
        order = np.lexsort((period, start))
        return start[order], end[order], period[order]


def runs(ids: np.ndarray, starts: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start``, ``end`` and ``period`` of all runs in texts laid end to end, ordered by start, then period."""
    if times < 4:
        raise ValueError("runs below four periods need not repeat two neighbouring blocks")
    found, size = _Found(), np.diff(starts)
    far = _returns(ids, starts)  # per block of the scale at hand: the longest way to a word's return
    blocks, scale = size, 1
    while (size >= times * scale).any():
        offset = np.concatenate([[0], np.cumsum(blocks)])
        text = np.repeat(np.arange(len(size)), blocks)
        begin = starts[text] + (np.arange(offset[-1]) - offset[text]) * scale
        end = starts[text + 1]
        at = np.flatnonzero((far < 2 * scale) & (begin + 2 * scale <= end))
        at = at[~found.holds(begin[at], np.minimum(begin[at] + 3 * scale, end[at]))]
        block, distance = _occurrences(ids, begin[at], end[at], scale)
        _extend(ids, starts, found, begin[at[block]], distance, text[at[block]], scale, least, times)
        half = blocks // 2
        first = np.repeat(offset[:-1], half) + 2 * _ranges(np.zeros(len(half), np.int64), half)
        far = np.maximum(far[first], far[first + 1])
        blocks, scale = half, 2 * scale
    return found.all()


def _occurrences(ids: np.ndarray, begin: np.ndarray, end: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which block occurs how far behind its begin, at distances scale .. 2 * scale - 1."""
    none = np.int64(0)  # no word has this number
    which, far = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = max(1, CELLS // (2 * scale))
    for i in range(0, len(begin), step):
        b, e = begin[i : i + step, None], end[i : i + step, None]
        place = b + scale + np.arange(2 * scale)
        window = np.where(place < e, ids[np.minimum(place, len(ids) - 1)], none).astype(np.uint64)
        block = ids[b + np.arange(scale)].astype(np.uint64)
        zero = mismatches(block, window) == 0
        row, d = np.nonzero(zero & (b + 2 * scale + np.arange(scale) <= e))
        which.append(row + i)
        far.append(d + scale)
    return np.concatenate(which), np.concatenate(far)


def _extend(ids, starts, found: _Found, begin, distance, text, scale: int, least: int, times: int) -> None:
    """Add the runs around chains of neighbouring blocks that repeat at one distance."""
    while True:
        order = np.lexsort((begin, distance))
        begin, distance, text = begin[order], distance[order], text[order]
        new = np.append(True, (np.diff(distance) != 0) | (np.diff(begin) != scale) | (np.diff(text) != 0))[: len(begin)]
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, len(begin)))
        # A run of ``times`` periods repeats a stretch of (times - 1) * q words, and the whole blocks in it.
        long = count >= np.maximum(1, ((times - 1) * distance[head] + 1) // scale - 1)
        long &= ~found.holds(begin[head], begin[head] + count * scale + distance[head], distance[head])
        head, count = head[long], count[long]
        pick = _ranges(head, count)
        right = _equal(ids, begin[pick], distance[pick], scale)
        if right.all():
            break
        begin, distance, text = (np.delete(x, pick[~right]) for x in (begin, distance, text))  # equal modulo PRIME only
    s, q, t = begin[head], distance[head], text[head]
    stop = s + count * scale
    low, high = starts[t], starts[t + 1] - q  # x and x + q both lie in the text
    s, stop = s - _reach(ids, s - 1, q, s - low, -1, scale), stop + _reach(ids, stop, q, high - stop, 1, scale)
    length = stop + q - s
    good = length >= np.maximum(least, times * q)
    found.add(s[good], (stop + q)[good], q[good])


def _equal(ids: np.ndarray, begin: np.ndarray, distance: np.ndarray, scale: int) -> np.ndarray:
    out, step = np.ones(len(begin), bool), max(1, CELLS // scale)
    for i in range(0, len(begin), step):
        place = begin[i : i + step, None] + np.arange(scale)
        out[i : i + step] = (ids[place] == ids[place + distance[i : i + step, None]]).all(1)
    return out


def _reach(ids: np.ndarray, at: np.ndarray, distance: np.ndarray, room: np.ndarray, way: int, scale: int) -> np.ndarray:
    """How many words from ``at`` on equal those ``distance`` further, walking ``way``, within ``room``."""
    out, todo = np.zeros(len(at), np.int64), np.arange(len(at))
    chunk = 8
    while len(todo):
        step, rest = max(1, CELLS // chunk), []
        for i in range(0, len(todo), step):
            part = todo[i : i + step]
            ahead = np.arange(chunk)
            inside = out[part, None] + ahead < room[part, None]
            place = np.where(inside, at[part, None] + way * (out[part, None] + ahead), 0)
            same = inside & (ids[place] == ids[np.where(inside, place + distance[part, None], 0)])
            run = np.where(same.all(1), chunk, same.argmin(1))
            out[part] += run
            rest.append(part[run == chunk])
        todo, chunk = np.concatenate(rest), min(2 * chunk, max(scale, 8))
    return out


def _groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > GROUP:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def _of_texts(texts: list[bytes], least: int, times: int) -> Iterator[tuple[int, list[dict], bytes]]:
    """Per text: number of words, runs, and the words left joined by one blank."""
    ids, starts, words = _numbered(texts)
    start, end, period = runs(ids, starts, least, times)
    keep = np.zeros(len(ids) + 1, np.int64)
    np.add.at(keep, start + period, 1)
    np.add.at(keep, end, -1)
    keep = np.cumsum(keep)[:-1] == 0
    first = np.searchsorted(start, starts)
    for i, own in enumerate(words):
        a, b = first[i], first[i + 1]
        if a == b:
            yield len(own), [], b" ".join(own)
            continue
        rows = zip((start[a:b] - starts[i]).tolist(), (end[a:b] - start[a:b]).tolist(), period[a:b].tolist())
        left = [w for w, k in zip(own, keep[starts[i] : starts[i + 1]].tolist()) if k]
        yield len(own), [{"start": s, "length": n, "period": q} for s, n, q in rows], b" ".join(left)


def found(docs: DataFrame, text: str = "text", least: int = LEAST, times: int = TIMES, columns: list[str] | None = None) -> DataFrame:
    """The input columns (or those named), ``words`` (how many), ``runs`` (array of ``start``, ``length``, ``period`` in
    words, by start, then period) and ``collapsed``: the words joined by one blank, of each run only its first period.

    Words compare by their bytes.  Null and empty texts have no words, no runs and an empty collapsed
    text.  Rows count each for itself, repeated ones included.  Result columns replace input columns of their name.
    """
    columns = docs.columns if columns is None else columns
    df = docs.select(packed(docs, columns=columns) if columns else F.struct(F.lit(0).alias("_")).alias("row"), F.coalesce(docs[text], F.lit("")).cast("binary").alias("text"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, rows = 0, batch.column("row")
            for group in _groups(batch.column("text").to_pylist()):
                n, found_runs, left = zip(*_of_texts(group, least, times))
                arrays = [rows.slice(done, len(group)), pa.array(n, pa.int64()), pa.array(found_runs, _ARROW), pa.array(left, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["row", "words", "runs", "collapsed"])
                done += len(group)

    empty = df.select("row").withColumns({"words": F.lit(0).cast("long"), "runs": F.lit(None).cast(_RUNS), "collapsed": F.lit(None).cast("binary")})
    out = df.mapInArrow(search, empty.schema)
    return unpacked(out, columns, {"words": F.col("words"), "runs": F.col("runs"), "collapsed": F.col("collapsed").cast("string")})


_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
