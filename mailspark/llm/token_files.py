"""Token ids in binary files: frequency-ranked ids in byte-aligned variable-length coding, the
lengths in separate control bytes, in order of the documents' ids.

A file is a Parquet part; each of its rows is a block of up to ``block`` documents: their ids and
token counts, the control bytes (four 2-bit lengths each) and the data bytes.  ``shard`` numbers
the files' ranges of document ids in ascending order.  Spark's writer commits the parts, so the
work of a lost executor is repeated as a whole.  The ranks lie beside them in ``ranks``.
"""

from __future__ import annotations

import gc
import string
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK = 256
#: Documents of one shard, about.
PER_SHARD = 16_384
MOST_SHARDS = 4_096
MOST_DOCS = 1_000_000
#: Pieces a worker keeps with their ids; bytes it encodes at once (what is made on the way takes several times that).
CACHED = 150_000
GROUP = 4_000_000
#: Bytes of a row group of the files, which its writer and its readers hold at once.
ROW_GROUP = 16 << 20
#: A blank that white space or nothing follows: what Python's ``re`` takes for white space, in terms of RE2.
BLANKS = r" (?:[\pZ\t-\r\x1c-\x1f\x{85}]|\z)"
#: Kinds of UTF-8 bytes between which the byte-level pattern cuts: Latin letters (of one and two bytes), digits, other ASCII signs
#: but for the apostrophe of its contractions, and line feeds, each by itself; 0 is the blank ahead of a stretch.
UNCOMMON = 9
SIGNS = np.full(256, UNCOMMON, np.uint8)
SIGNS[[*string.ascii_letters.encode(), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = 1
SIGNS[[*string.digits.encode()]] = 2
SIGNS[[*string.punctuation.replace("'", "").encode()]] = 3
SIGNS[10] = 4


class Encoder:
    """A tokenizers file; ids of stretches between certain borders are kept, for they recur.

    Before a blank that a visible character follows a byte-level vocabulary always cuts, but for
    texts that hold an added token, which go to the tokenizer whole.  With ``plain`` the name of a
    special token is text like any other; without, it is that token, the library's default."""

    def __init__(self, path: str, cached: int = CACHED, plain: bool = True):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if not (plain and t.special)]
        self.blank = re.compile(r" (?=\S)")
        self.cuts_as_known = self.tokenizer.normalizer is None and type(self.model).__name__ == "BPE" and self._cuts_as_known(path)
        sign = {own: own for own in [*range(33, 127), *range(161, 173), *range(174, 256)]}  # the signs that stand for bytes
        self.signs = {byte: chr(sign.get(byte, 256 + i)) for i, byte in enumerate(sorted(range(256), key=lambda b: (b in sign, b)))}
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.bytes_of = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            self.bytes_of[number] = len(token)  # a byte-level token has a character for each byte
        self.cached, self.known, self.older = cached, {}, {}

    @staticmethod
    def _cuts_as_known(path: str) -> bool:
        """Whether the file has the byte-level pattern that SIGNS are made for, with no blank put ahead."""
        import json

        with open(path, encoding="utf-8") as file:
            own = json.load(file)["pre_tokenizer"] or {}
        return own.get("type") == "ByteLevel" and own.get("use_regex", True) and not own.get("add_prefix_space", True)

    def of_model(self, pieces: list[str]) -> Iterator[bytes]:
        """Ids of pieces that the pattern does not cut, by the library's model alone."""
        spelled = "\0".join(pieces).encode().decode("latin-1").translate(self.signs).split(self.signs[0]) if pieces else []
        tokenize, code = self.model.tokenize, np.dtype(self.kind).char
        return (array(code, [token.id for token in tokenize(piece)]).tobytes() for piece in spelled)

    def ids_of(self, pieces: list[str], other: set[str]) -> list[bytes]:
        """Ids of different pieces; those not met of late go to the library, all but ``other`` to its model alone."""
        ids = list(map(self.known.get, pieces))
        new = [i for i, found in enumerate(ids) if found is None]
        before = self.older
        if len(self.known) + len(new) > self.cached:  # what is not asked for again leaves with the older half
            self.older, self.known = self.known, {}
        for i in new:
            ids[i] = before.get(pieces[i])
        lacking = [pieces[i] for i in new if ids[i] is None]
        for make, own in ((self.of_model, [p for p in lacking if p not in other]), (self.fresh, [p for p in lacking if p in other])):
            self.known.update(zip(own, make(own)))
        for i in new:
            ids[i] = self.known.setdefault(pieces[i], ids[i])
        return ids

    def of_stretches(self, stretches: pa.Array) -> pa.Array:
        """Ids of a blank and a stretch, for each; every different piece of stretches of common signs is looked up once."""
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), stretches, pa.scalar("", pa.large_string()))
        bounds = np.frombuffer(spaced.buffers()[1], np.int64)[: len(spaced) + 1]
        raw = np.frombuffer(spaced.buffers()[2] or b"", np.uint8)[: bounds[-1]]
        first, signs = bounds[:-1], SIGNS[raw]
        signs[first] = 0
        line = signs[1:] == SIGNS[10]
        odd = signs == UNCOMMON
        odd[1:] |= (signs[:-1] == SIGNS[10]) & line  # white space stays together
        odd[1:] |= (raw[:-1] == 0xC3) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7))  # signs of multiplication and division
        odd = np.logical_or.reduceat(odd, first) if self.cuts_as_known and len(first) else np.ones(len(first), bool)
        begins = np.ones(len(raw), bool)
        begins[1:] = ((signs[1:] != signs[:-1]) & (signs[:-1] > 0)) | line
        begins &= ~np.repeat(odd, np.diff(bounds))
        begins[first] = True
        starts = np.flatnonzero(begins)
        pieces = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(np.append(starts, len(raw))), spaced.buffers()[2]]).dictionary_encode()
        names, which = pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), pieces.indices.to_numpy()
        places = np.searchsorted(starts, first)  # of the stretches' first pieces
        other = {name for name in (names[i] for i in which[places[odd]].tolist()) if not (self.cuts_as_known and name[1:].isalpha())}
        ids = pa.array(self.ids_of(names, other), pa.large_binary()).take(pieces.indices)
        sums = np.frombuffer(ids.buffers()[1], np.int64)[: len(ids) + 1]
        return laid(sums[np.append(places, len(ids))], ids.buffers()[2])

    def fresh(self, texts: list[str], row: int = 256) -> list[bytes]:
        """Ids of texts, each of which is cut for itself.

        They go to the tokenizer in rows; the bytes that ids stand for tell where a text ends."""
        out = []
        for start in range(0, len(texts), 64 * row):
            part = texts[start : start + 64 * row]
            rows = [part[i : i + row] for i in range(0, len(part), row)]
            made = self.tokenizer.encode_batch_fast(rows, is_pretokenized=True, add_special_tokens=False)
            ids = np.concatenate([np.array(m.ids, self.kind) for m in made])
            ends = np.cumsum([len(text.encode()) for text in part])
            cuts = [0, *(np.searchsorted(np.cumsum(self.bytes_of[ids]), ends) + 1).tolist()]
            out += [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        return out

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Stretches of the texts end to end, the blanks between them left out; their numbers, and whose they are."""
        whole = np.zeros(len(texts), bool)
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        # White space after a blank belongs to the stretch before it.
        odd = whole | pc.match_substring_regex(texts, BLANKS).to_numpy(zero_copy_only=False)
        plain = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        which = np.flatnonzero(odd)
        other = [[text] if w else self.blank.split(text) for text, w in zip(texts.take(pa.array(which)).to_pylist(), whole[which])]
        values = pa.concat_arrays([plain.flatten(), pa.array(list(chain.from_iterable(other)), pa.large_string())])
        return values, np.concatenate([pc.list_value_length(plain).to_numpy(), np.array([len(o) for o in other], np.int64)]), np.concatenate([np.flatnonzero(~odd), which])

    def encode_array(self, texts: pa.Array, end: int) -> pa.Array:
        """Ids of each text (large strings, none null) and the end id, as little-endian unsigned integers of ``kind``."""
        n = len(texts)
        values, counts, whose = self.cut(texts)
        first = np.cumsum(counts) - counts
        later = np.ones(len(values), bool)
        later[first] = False
        different = values.filter(pa.array(later)).dictionary_encode()
        made = self.of_stretches(different.dictionary)
        n_made = len(made)
        # Only the first stretch of a text has no leading blank; it is left to the tokenizer.
        heads = self.tokenizer.encode_batch_fast(values.take(pa.array(first)).to_pylist(), add_special_tokens=False)
        heads = [np.array(m.ids, self.kind).tobytes() for m in heads]
        made = pa.concat_arrays([made, pa.array([*heads, np.array([end], self.kind).tobytes()], pa.large_binary())])
        # Numbers of all that is laid end to end: each text's head, its stretches, the end id.
        first, last = first + np.arange(n), first + np.arange(n) + counts
        which, later = np.empty(len(values) + n, np.int64), np.ones(len(values) + n, bool)
        which[first], which[last] = n_made + np.arange(n), n_made + n
        later[first] = later[last] = False
        which[later] = different.indices.to_numpy()
        ids = made.take(pa.array(which))
        sums = np.frombuffer(ids.buffers()[1], np.int64)[: len(ids) + 1]
        return laid(sums[[*first, len(ids)]], ids.buffers()[2]).take(pa.array(np.argsort(whose)))

    def encode(self, texts: list[str], end: int) -> list[bytes]:
        return self.encode_array(pa.array(texts, pa.large_string()), end).to_pylist()

    def forget(self) -> None:
        self.known, self.older = {}, {}


def laid(sums: np.ndarray, data: pa.Buffer) -> pa.Array:
    """Binary values that lie end to end in ``data``, from each of ``sums`` to the next."""
    return pa.Array.from_buffers(pa.large_binary(), len(sums) - 1, [None, pa.py_buffer(sums.astype(np.int64)), data])


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path, plain=False)


def in_groups(batches: Iterable[pa.RecordBatch], path: str, end: int) -> Iterator[pa.RecordBatch]:
    """The batches (``doc``, ``tie``, ``text``) with ``ids`` in place of the text, GROUP bytes at once."""

    def coded(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        doc, tie, text = (pa.concat_arrays([batch.column(name) for batch in held]) for name in ("doc", "tie", "text"))
        ids = encoder(path).encode_array(text.cast(pa.large_string()), end)
        return pa.RecordBatch.from_arrays([doc, tie, ids.cast(pa.binary())], ["doc", "tie", "ids"])

    gc.disable()  # millions of strings and no cycles: its rounds cost more than they free
    try:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= GROUP:
                yield coded(held)
                held, size = [], 0
        if held:
            yield coded(held)
    finally:  # workers live on into the stages that follow
        gc.enable()
        encoder(path).forget()
        pa.default_memory_pool().release_unused()


def ids_of(docs: DataFrame, path: str, end: int, name: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc``, ``tie``, ``ids`` (binary) of every whole text; each task meets the tokenizer with
    groups of texts of bounded size."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_groups(batches, path, end)

    texts = docs.select(docs[name].cast("long").alias("doc"), F.xxhash64(docs[text]).alias("tie"), F.coalesce(docs[text], F.lit("")).alias("text"))
    return texts.mapInArrow(encode, "doc long, tie long, ids binary")


# --- the coding -----------------------------------------------------------------------------


def packed(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ranks below 2 ** 32: little-endian bytes without the
    upper zero ones."""
    ranks = ranks.astype("<u4")
    most = int(ranks.max(initial=0))
    size = np.ones(len(ranks), np.uint8)
    for limit in (0xFF, 0xFFFF, 0xFFFFFF):
        if most > limit:
            size += ranks > limit
    ends = np.cumsum(size, dtype=np.int64)
    start = ends - size
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    data[start] = ranks.astype(np.uint8)
    for i in range(1, int(size.max(initial=1))):
        has = np.flatnonzero(size > i)
        data[start[has] + i] = (ranks[has] >> np.uint32(8 * i)).astype(np.uint8)
    code = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    code[: len(ranks)] = size - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    return control.astype(np.uint8).tobytes(), data.tobytes()


#: The four lengths that each control byte stands for.
LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.int64)


def unpacked(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks, by table lookup of the lengths."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    start = np.cumsum(size) - size
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    ranks = raw[start].astype(np.uint32)
    for i in range(1, int(size.max(initial=1))):
        has = np.flatnonzero(size > i)
        ranks[has] |= raw[start[has] + i].astype(np.uint32) << np.uint32(8 * i)
    return ranks


# --- tables ---------------------------------------------------------------------------------


def counts(ids: DataFrame, kind: type) -> DataFrame:
    """``id`` and ``n`` over all documents; each task adds up what it has read."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, np.int64)
        for batch in filter(len, batches):
            own = np.bincount(np.frombuffer(b"".join(batch["ids"]), kind), minlength=len(total))
            own[: len(total)] += total
            total = own
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"id": seen, "n": total[seen]})

    return ids.select("ids").mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def borders(names: DataFrame) -> np.ndarray:
    """Ascending borders of the shards, approximate quantiles of all document ids (column ``k``).

    One shard per PER_SHARD documents up to MOST_SHARDS, then per MOST_DOCS: the driver and the
    broadcast see one number per shard."""
    docs = names.count()
    n = max(1, min(docs // PER_SHARD, max(MOST_SHARDS, docs // MOST_DOCS)))
    cuts = names.approxQuantile("k", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else []
    return np.array(sorted(set(map(int, cuts))), np.int64)


def write(docs: DataFrame, folder: str, path: str, end: int, name: str = "doc_id", text: str = "text", block: int = BLOCK) -> None:
    """Encode every whole text and write the files to ``folder``.

    Null and empty texts give the end id alone.  Documents without an id come first; repeated
    ids stay in the order of a hash of their texts.  An empty table gives no blocks.
    """
    spark, kind = docs.sparkSession, encoder(path).kind
    ids_of(docs, path, end, name, text).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/ids")
    ids = spark.read.parquet(f"{folder}/ids")
    ranks = counts(ids, kind).orderBy(F.col("n").desc(), "id")  # one row per token of the vocabulary
    ranks.coalesce(1).write.mode("overwrite").parquet(f"{folder}/ranks")
    ranked = ids_of_ranks(spark, folder)
    rank = np.zeros(int(ranked.max(initial=0)) + 1, np.uint32)
    rank[ranked] = np.arange(len(ranked), dtype=np.uint32)
    table = spark.sparkContext.broadcast(rank)

    cuts = borders(ids.select(F.col("doc").alias("k")))

    @F.pandas_udf("int")
    def shard_of(doc: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, doc.to_numpy(np.int64), side="left"))

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, shard, place, before = pd.DataFrame(), None, 0, 0
        for batch in chain(batches, [None]):
            held = pd.concat([held, batch]) if batch is not None else held
            while len(held) and (batch is None or len(held) >= block or held["shard"].iloc[0] != held["shard"].iloc[-1]):
                own = held[held["shard"] == held["shard"].iloc[0]].iloc[:block]
                held = held.iloc[len(own) :]
                if own["shard"].iloc[0] != shard:
                    shard, place, before = own["shard"].iloc[0], 0, 0
                sizes = own["ids"].str.len() // np.dtype(kind).itemsize
                control, data = packed(table.value[np.frombuffer(b"".join(own["ids"]), kind)])
                doc = [None if pd.isna(d) else int(d) for d in own["doc"]]
                yield pd.DataFrame({"shard": [shard], "place": [place], "before": [before], "docs": [doc], "sizes": [sizes.tolist()], "control": [control], "data": [data]})
                place, before = place + 1, before + int(sizes.sum())

    first = F.lit(np.iinfo(np.int64).min)  # documents without an id
    coded = ids.select(shard_of(F.coalesce("doc", first)).alias("shard"), "doc", "tie", "ids")
    # One shard a task: by hash some tasks would get several and others none.
    coded = coded.repartitionById(len(cuts) + 1, "shard").sortWithinPartitions("shard", F.asc_nulls_first("doc"), "tie")
    blocks = coded.mapInPandas(join, "shard int, place int, before long, docs array<long>, sizes array<int>, control binary, data binary")
    small = {"compression": "zstd", "parquet.block.size": ROW_GROUP, "parquet.page.size.row.check.min": 1}  # a row is large, so each is looked at
    blocks.write.mode("overwrite").options(**small).parquet(f"{folder}/blocks")


def ids_of_ranks(spark: SparkSession, folder: str) -> np.ndarray:
    """The vocabulary's ids in order of rank; bounded by the vocabulary."""
    rows = spark.read.parquet(f"{folder}/ranks").collect()
    return np.array([r["id"] for r in sorted(rows, key=lambda r: (-r["n"], r["id"]))], np.int64)


def read(spark: SparkSession, folder: str, checksum: bool = False) -> DataFrame:
    """``doc``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``, from the files; with
    ``checksum`` not the ids, but ``crc32``, unsigned, of them as little-endian unsigned 32-bit integers."""
    table = spark.sparkContext.broadcast(ids_of_ranks(spark, folder).astype(np.uint32))
    blocks = spark.read.parquet(f"{folder}/blocks")
    tokens = blocks.groupBy("shard").agg(F.sum(F.expr("aggregate(sizes, 0L, (a, x) -> a + x)")).alias("tokens"))
    first = tokens.select("shard", (F.sum("tokens").over(Window.orderBy("shard")) - F.col("tokens")).alias("first"))
    placed = blocks.join(F.broadcast(first), "shard")  # one row per shard
    placed = placed.select("docs", "sizes", "control", "data", (F.col("first") + F.col("before")).alias("start"))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for docs, sizes, control, data, start in zip(batch["docs"], batch["sizes"], batch["control"], batch["data"], batch["start"]):
                ids = table.value[unpacked(control, data, int(np.sum(sizes)))]
                ends = np.cumsum(sizes)
                own = {"doc": pd.array(docs, "Int64"), "start": start + ends - sizes, "n_tokens": sizes}
                if checksum:
                    raw = memoryview(ids.astype("<u4").tobytes())
                    last = {"crc32": [zlib.crc32(raw[4 * (e - n) : 4 * e]) for n, e in zip(sizes, ends)]}
                else:
                    last = {"ids": np.split(ids.astype(np.int32), ends[:-1])}
                yield pd.DataFrame(own | last)

    return placed.mapInPandas(decode, "doc long, start long, n_tokens long, " + ("crc32 long" if checksum else "ids array<int>"))
