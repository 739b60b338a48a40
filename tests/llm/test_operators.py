"""The operators against plain versions, over texts with every kind of edge."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mailspark.llm import byte_bpe, fingerprints, jaccard_join, line_dedup, mixing, quality_classifier, quality_rules, substring_dedup, token_files, toxicity
from mailspark.session import work_dir
from tests.llm import plain

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, score string, size string, ids string, fingerprint string, n_words string, __l string, hits string"


def _texts():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdeéß") for _ in range(rnd.randrange(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, base = prose(60), prose(300)
    near = base.split(" ")
    near[17] = "changed"
    near[200] = "again"
    return [
        None, "", " \n\t ", "one", "one", "two words", base, base, " ".join(near), base + " tail of it",
        "head " + passage + "\nand more\nlines here", prose(40) + " " + passage, passage, "a b c " * 80,
        "l1 x\nl2 y\nl3 z\n\nl4", "other\nl1 x\nl2 y\n\nl3 z\nend", "l1 x\nl2 y", "THE!! AND!! " * 30, "*** $$$ ||| " * 40,
        prose(4000) + "\n" + passage, "x" * 30_000, "é" * 500 + " " + "中文 " * 300, "\r\n\x0b tab\tsep\x0c", "don't we'll  two  spaces \n\n \n new",
        *(prose(rnd.randrange(1, 90)) for _ in range(25)),
    ]


@pytest.fixture(scope="module")
def rows():
    texts = _texts()
    return [(i * 3, t, "en", None if i % 7 == 0 else f"s{i % 4}", 0 if t is None else len(t), *["own"] * 8) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    """Documents, one without an id, one twice, dealt over several partitions."""
    return spark.createDataFrame([*rows, (None, "no id here", None, None, None, *["own"] * 8), rows[5]], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *columns, key="doc_id"):
    return {r[key]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect() if r[key] is not None}


def test_quality_measures(docs, rows):
    df = quality_rules.judged(docs)
    assert set(docs.columns) <= set(df.columns) and df.count() == docs.count()
    got = by_id(df, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert got == {r[0]: plain.measures(r[1]) for r in rows}
    failed = by_id(df, "base_failed")
    for i, (n, _, _, _, again) in got.items():
        assert failed[i] == (n < 50 or 100 * again > 50 * n)
    assert not any(k and f for k, f in by_id(df, "kept", "base_failed").values())


def test_windows_of_one_hash_are_told_apart(spark, monkeypatch):
    """With so short a hash that most windows share one, only windows of equal words count, but for
    those parted by two or more others."""
    texts = [(0, "a b c d e f g a b c"), (1, " ".join("abcdefghijklmnopqrstuvwxyz")), (2, "x y z x y z x y z"), (3, "a a a"), (4, "a a a a"), (5, "")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.row.doc_id: r.n_repeat_words for r in quality_rules.measured(df).collect()}
    assert got == {i: plain.measures(t)[4] for i, t in texts}
    whole = quality_rules.F.expr
    monkeypatch.setattr(quality_rules.F, "expr", lambda x: whole(x.replace("xxhash64(w[i], w[i + 1], w[i + 2])", "0L")))
    got = {r.row.doc_id: r.n_repeat_words for r in quality_rules.measured(df).collect()}
    assert got[1] == got[5] == 0 and got[4] == 4 and got[3] == 0


def plain_posteriors(votes, rounds=200):
    """Expectation-maximisation over single documents: p(good) of each."""
    prior, right = 0.8, [0.8] * len(votes[0])
    for turn in range(rounds + 1):
        p = []
        for own in votes:
            good, bad = prior, 1 - prior
            for v, a in zip(own, right):
                good *= {1: a, -1: 1 - a, 0: 1}[v]
                bad *= {1: 1 - a, -1: a, 0: 1}[v]
            p.append(good / (good + bad))
        if turn == rounds:
            return p
        for j in range(len(right)):
            cast = [(x if own[j] > 0 else 1 - x) for own, x in zip(votes, p) if own[j]]
            right[j] = min(0.98, max(0.55, sum(cast) / len(cast))) if cast else right[j]
        prior = min(0.98, max(0.02, sum(p) / len(p)))


def test_quality_verdicts_equal_plain(docs):
    got = quality_rules.judged(docs).collect()
    for r, p in zip(got, plain_posteriors([tuple(r.votes) for r in got])):
        assert abs(r.p_good - p) < 1e-5 and (abs(p - 0.5) < 1e-4 or r.kept == (not r.base_failed and p >= 0.5))


def test_columns_named_like_the_operators_own(spark, docs):
    wide = docs.withColumns({"_": F.lit("u"), "toxic": F.lit(1), "__name": F.lit("n"), "__text": F.lit("t"), "label": F.lit("l"), "row": F.lit("r")})
    assert {r["_"] for r in quality_rules.judged(wide).collect()} == {"u"} == {r["_"] for r in mixing.mix(wide).collect()}
    known, labels = _labelled(spark)
    known = known.withColumns({"toxic": F.lit(0), "__name": F.lit("n"), "__text": F.lit("t"), "quality": F.lit(0), "label": F.lit("l"), "doc": F.lit("d")})
    categories = toxicity.by_language(known, labels)
    texts = toxicity.sample(known, labels, categories)
    assert texts.where("array_max(labels) = 1").count() > 50
    got = toxicity.scored(known, toxicity.learnt(texts, tuple(categories))).collect()
    assert all(r.toxic == (r.doc_id is not None and r.doc_id < 400 and r.doc_id % 5 == 0) and r["__name"] == "n" for r in got)


def test_quality_rules_learn_accuracies():
    rnd = np.random.default_rng(3)
    truth, right = rnd.random(20_000) < 0.7, [0.95, 0.9, 0.8, 0.65]
    votes = np.stack([np.where(rnd.random(len(truth)) < 0.2, 0, np.where(rnd.random(len(truth)) < a, 1, -1) * np.where(truth, 1, -1)) for a in right], 1)
    seen, n = np.unique(votes, axis=0, return_counts=True)
    model = quality_rules.estimate([(tuple(map(int, v)), int(k)) for v, k in zip(seen, n)], 4)
    assert np.allclose(model.accuracy, right, atol=0.03) and abs(model.prior - 0.7) < 0.03


def test_quality_rules_empty(none):
    assert quality_rules.judged(none).count() == 0
    assert quality_rules.passed(none).columns == none.columns


def test_passed_keeps_columns(docs):
    kept = quality_rules.passed(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, k in by_id(quality_rules.judged(docs), "kept").items() if k}


def test_mixing(docs, rows, none):
    df = mixing.mix(docs)
    got = df.collect()
    assert len(got) == docs.count()
    sizes = {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = plain.targets(sizes)
    for r in got:
        assert r["size"] == len(plain.words(r["text"])) and r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6 and 0 <= r["times"] <= 3
        assert r["times"] >= int(want[r["source"]] // max(sizes[r["source"]], 1))
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix(docs.repartition(2)).collect()), key=repr)
    assert mixing.mixed(docs).count() == sum(r["times"] for r in got) and mixing.mixed(docs).columns == docs.columns
    assert mixing.mix(none).count() == 0


def test_mixing_meets_targets(spark):
    rows = [(i, "w " * (1 + i * 7 % 40), f"s{i % 9}") for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken = {}
    for r in got:
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["times"]
    assert all(abs(taken[r["source"]] - r["target"]) < 20 for r in got)  # half of the longest text


def test_source_above_all_caps(spark):
    rows = [(1, "a " * 1000, "x"), (2, "b " * 10, "y"), (3, "", "z")]
    got = by_id(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")), "target")
    want = plain.targets({"x": 1000, "y": 10, "z": 0})
    assert got == pytest.approx({1: want["x"], 2: want["y"], 3: want["z"]})


@pytest.fixture(scope="module")
def vocabulary():
    import base64

    import public_tokenizers as public
    import tiktoken

    path = public.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return path, public.PATTERN, tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("chunk", [65_536, 64])
def test_byte_bpe(docs, rows, none, vocabulary, chunk):
    path, pattern, plainly = vocabulary
    df = byte_bpe.encoded(docs, path, pattern, chunk=chunk, overlap=16)
    assert df.count() == docs.count() and df.columns == [*[c for c in docs.columns if c != "ids"], "ids"]
    df = df.withColumn("raw", byte_bpe.decoded(df["ids"], path))
    both = byte_bpe.encoded(docs, path, pattern, chunk=chunk, overlap=16, decode=True)
    assert by_id(both, "ids", "raw") == by_id(df, "ids", "raw")
    for i, (ids, raw) in by_id(df, "ids", "raw").items():
        text = dict((r[0], r[1]) for r in rows)[i] or ""
        assert list(ids) == plainly.encode_ordinary(text) and bytes(raw) == text.encode()
    assert byte_bpe.encoded(none, path, pattern).count() == 0


def test_pieces_of_chunks(vocabulary):
    coder, rnd = byte_bpe.Coder(*vocabulary[:2]), random.Random(2)
    signs = [*"ab cd  \n\t'sre12,.!é中　\x85 ", "'ll", " x", "\r\n", "a" * 40, " " * 30]
    for _ in range(400):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randrange(1, 200)))
        assert coder.encode(text).tolist() == vocabulary[2].encode_ordinary(text)
        step = rnd.randrange(4, 30)
        texts = [text[i : i + step + 3] for i in range(0, len(text), step)]
        got = list(byte_bpe.stitched(texts, [coder.ends(t) for t in texts], step, lambda t, at: coder.pattern.match(t, at).end()))
        assert got == [m.span() for m in coder.pattern.finditer(text)]


def test_substring_dedup(docs, rows, none):
    got = by_id(substring_dedup.deduplicated(docs), "n_words", "n_removed", "text", key="id")
    assert got == plain.substring([(r[0], r[1]) for r in rows])
    assert sum(n for _, n, _ in got.values()) > 1000
    assert substring_dedup.deduplicated(none).count() == 0


def test_substring_dedup_of_frequent_windows(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "FREQUENT", 3)
    rnd = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, " ".join(rnd.choice("abcdefg") for _ in range(20)) + " " + passage + f" e{i}") for i in range(20)]
    df = substring_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert by_id(df, "n_words", "n_removed", "text", key="id") == plain.substring(rows)


def test_substring_dedup_cuts_anchors_with_many_different_stretches(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "FREQUENT", 3)
    monkeypatch.setattr(substring_dedup, "DIFFERENT", 2)
    rnd = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(9))
    around = lambda n: " ".join(rnd.choice("xyz") for _ in range(n))
    rows = [(i // 2, f"{around(8)} {passage} {around(8)}") for i in range(200)]
    rows += [(300 + i, rows[7][1]) for i in range(40)] + [(500, " ".join([passage] * 40)), (501, " ".join([passage] * 60))]
    df = substring_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((r["id"], r["n_words"], r["n_removed"], r["text"]) for r in df.collect())
    size, first = 13, {}
    for i, text in rows:
        w = text.split()
        for j in range(len(w) - size + 1):
            key = tuple(w[j : j + size])
            first[key] = min(i, first.get(key, i))
    expected = []
    for i, text in rows:
        w = text.split()
        gone = {k for j in range(len(w) - size + 1) if first[tuple(w[j : j + size])] < i for k in range(j, j + size)}
        expected.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    assert got == sorted(expected)
    assert sum(n for _, _, n, _ in got) > 1000


def test_shards_hold_whole_anchors(monkeypatch):
    monkeypatch.setattr(substring_dedup, "INDEXED", 60)
    rnd = random.Random(6)
    names = sorted(rnd.randrange(40) for _ in range(300))
    rows = pd.DataFrame({"anchor": names, "no": range(300), "words": [b"x" * substring_dedup.SYMBOL * rnd.randrange(13, 20) for _ in names]})
    cuts = sorted(rnd.randrange(1, 300) for _ in range(12))
    parts = list(substring_dedup.shards(rows.iloc[a:b] for a, b in zip([0, *cuts], [*cuts, 300])))
    assert pd.concat(parts)["no"].tolist() == list(range(300))
    assert len(parts) > 10 and sum(p["anchor"].nunique() for p in parts) == len(set(names))


def test_substring_search_takes_and_gives_arrow_batches(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(substring_dedup, "INDEXED", 200)
    rnd, rows, first = random.Random(9), [], {}
    for anchor in range(12):
        for _ in range(rnd.randrange(1, 9)):
            rows.append((anchor, rnd.randrange(30), len(rows), rnd.randrange(50), bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(13, 18)))))
    for anchor, i, _, _, w in rows:
        for j in range(len(w) - 12):
            first[anchor, w[j : j + 13]] = min(i, first.get((anchor, w[j : j + 13]), i))
    # Equal words of other anchors meet only where they share an index, so the anchor is part of each word.
    spelled = [b"".join(bytes([c, anchor, 0, 0, 0, 0]) for c in w) for anchor, *_, w in rows]
    table = pa.table({"anchor": [r[0] for r in rows], "id": [r[1] for r in rows], "tie": [r[2] for r in rows], "start": pa.array([r[3] for r in rows], pa.int32()), "words": pa.array(spelled, pa.binary())})
    got = {(r["id"], r["tie"]): r["hits"] for batch in substring_dedup.search(iter(table.to_batches(max_chunksize=7))) for r in batch.to_pylist()}
    want = {(i, tie): [start + j for j in range(len(w) - 12) if first[anchor, w[j : j + 13]] < i] for anchor, i, tie, start, w in rows}
    assert got == {k: v for k, v in want.items() if v} and len(got) < len(want)


def test_words_of_many_texts():
    from mailspark.llm import hashing

    rnd = random.Random(10)
    texts = ["", "a", "a b", " ", *("".join(rnd.choice("ab\x00\x08\t\n\x0b\x0c\r\x0e\x1f \x85é!") for _ in range(rnd.randrange(30))) for _ in range(200)), "", "end"]
    raw = [t.encode() for t in texts]
    for part in ([], [b""], [b" "], [b"x"], raw):
        w = hashing.words(part)
        got = [(t, w.raw[a : a + n].tobytes()) for t, a, n in zip(w.text.tolist(), w.start.tolist(), w.length.tolist())]
        assert got == [(i, x) for i, t in enumerate(part) for x in t.split()]
        assert len(set(zip(w.hash.tolist(), (x for _, x in got)))) == len(set(w.hash.tolist())) == len({x for _, x in got})


def test_fm_index_matches_plain_search():
    rnd = np.random.default_rng(1)
    parts = [rnd.integers(0, 3, rnd.integers(13, 25)).astype(np.uint64) for _ in range(60)]
    owners = rnd.integers(0, 1000, 60)
    got = substring_dedup.least_documents(np.concatenate(parts), np.array([len(p) for p in parts]), owners)
    got = np.split(got, np.cumsum([len(p) - 12 for p in parts])[:-1])
    seen = {}
    for p, o in zip(parts, owners):
        for i in range(len(p) - 12):
            seen.setdefault(tuple(p[i : i + 13]), []).append(o)
    for p, g in zip(parts, got):
        assert g.tolist() == [min(seen[tuple(p[i : i + 13])]) for i in range(len(p) - 12)]


def test_line_dedup(docs, rows, none):
    df = line_dedup.deduplicated(docs)
    assert df.columns == [*docs.columns, "__lines", "__gone"] and df.count() == docs.count()
    want = plain.lines([(r[0], r[1]) for r in rows])
    assert by_id(df, "text") == want and any(want[r[0]] != r[1] for r in rows)
    assert line_dedup.deduplicated(none).count() == 0


def test_line_dedup_random(spark):
    rnd = random.Random(8)
    pool = ["", " ", *(f"line {i}" for i in range(12)), "w " * 60]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randrange(0, 12)))) for i in range(60)]
    for size in (2, 3):
        df = line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), lines=size)
        assert by_id(df, "text") == plain.lines(rows, size)


def test_line_dedup_tells_texts_of_one_id_apart(spark):
    rows = [(2, "aa bb\ncc dd\nff"), (2, "uniq one\nuniq two\nff"), (1, "aa bb\ncc dd"), (3, "汉" * 40), (4, "汉" * 40), (5, "x" * 39), (6, "x" * 39), (7, "uniq one\nuniq two\nff"), (2, "aa bb\ncc dd\nff")]
    docs = spark.createDataFrame([(i, t, "own", "own", "own", "own") for i, t in rows], "doc_id long, text string, gone string, __id string, __l string, __gone string")
    df = line_dedup.deduplicated(docs)
    assert set(df.columns) == {*docs.columns, "__lines"}
    got = sorted((r["doc_id"], r["text"]) for r in df.collect() if r["gone"] == r["__id"] == r["__l"] == "own")
    assert got == sorted([(2, "ff"), (2, "ff"), (2, "uniq one\nuniq two\nff"), (1, "aa bb\ncc dd"), (3, "汉" * 40), (4, ""), (5, "x" * 39), (6, "x" * 39), (7, "")])


def test_line_dedup_deals_hot_runs(spark, monkeypatch):
    rows = [(i, f"the very same long line of boilerplate here, again\nown {i} a\nmore {i % 9}\nend") for i in range(80)]
    want = plain.lines(rows)
    monkeypatch.setattr(line_dedup, "HOT", 20)
    assert by_id(line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")), "text") == want


def test_token_coding():
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = np.random.default_rng(n).integers(0, 2**32, n) >> np.random.default_rng(n + 1).integers(0, 32, n)
        assert (token_files.unpacked(*token_files.packed(ranks), n) == ranks).all()


def test_token_files(spark, docs, rows, none):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    path, out = public.path("byte_bpe_50k.json"), work_dir(spark, "tokens")
    token_files.write(docs, out, path, end=2, block=4)
    got = [tuple(r) for r in token_files.read(spark, out).collect()]
    sums = {r["start"]: r["crc32"] for r in token_files.read(spark, out, checksum=True).collect()}
    assert sums == {start: zlib.crc32(np.array(ids, "<u4").tobytes()) for _, start, _, ids in got}
    tokenizer = Tokenizer.from_file(path)
    ids = lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
    want, start = [], 0
    for doc, text in [(None, "no id here"), *sorted([(r[0], r[1]) for r in [*rows, rows[5]]], key=lambda r: r[0])]:
        want.append((doc, start, len(ids(text)), ids(text)))
        start += len(ids(text))
    assert sorted(got, key=lambda r: r[1]) == want
    token_files.write(none, out + "-none", path, end=2)
    assert token_files.read(spark, out + "-none").count() == 0


def test_encoder_equals_the_library():
    import public_tokenizers as public
    from tokenizers import Tokenizer

    path, rnd = public.path("byte_bpe_50k.json"), random.Random(3)
    encoder, tokenizer = token_files.Encoder(path, cached=50), Tokenizer.from_file(path)
    signs = [*"ab cd  \n\t'sre12,.!é中　\x85 ", "'ll", " x", "\r\n", " don't", " <|endoftext|>"]
    tokenizer.encode_special_tokens = True
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(0, 60))) for _ in range(300)]
    for i in range(0, 300, 30):
        for text, ids in zip(texts[i : i + 30], encoder.encode(texts[i : i + 30], 2)):
            assert np.frombuffer(ids, encoder.kind).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_encoder_meets_different_pieces_once():
    """Stretches of common signs go to the library's model piece by piece, each piece once; the rest as before."""
    import public_tokenizers as public
    from tokenizers import Tokenizer

    path, rnd = public.path("byte_bpe_50k.json"), random.Random(4)
    encoder, tokenizer = token_files.Encoder(path), Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    signs = [*"abéßſĀ×÷ªºñ10²½.,;:_#*'\"%()\n\0\t\r\x85\xa0　中", "\n\n", ".\n", "'s", "n't", "  ", " \n", "\n ", *[" "] * 12]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(0, 40))) for _ in range(3000)]
    for text, ids in zip(texts, encoder.encode(texts, 2)):
        assert np.frombuffer(ids, encoder.kind).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], text
    asked = []
    encoder.forget()
    encoder.fresh = lambda own: asked.extend(own) or [b""] * len(own)
    encoder.encode(["x one, two.\nÉtwo 12;one, don't"], 2)
    assert asked == [" don't"]


def test_encoder_asks_once_for_a_word_with_and_without_signs():
    from types import SimpleNamespace

    import public_tokenizers as public
    from tokenizers import Tokenizer

    path, asked = public.path("byte_bpe_50k.json"), []
    encoder, tokenizer = token_files.Encoder(path), Tokenizer.from_file(path)
    own = encoder.model
    encoder.model = SimpleNamespace(tokenize=lambda piece: asked.append(piece) or own.tokenize(piece))
    texts = ["x one two, one, (two) one.\nTwo été 12,", "y one two été. 12 12.", "", "one  two \n", "×÷ a×b a÷b é×é", "a\n\nb c\nd e\n f\n"]
    for text, ids in [*zip(texts, encoder.encode(texts, 2)), *zip(texts[::-1], encoder.encode(texts[::-1], 2))]:
        assert np.frombuffer(ids, encoder.kind).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], text
    assert len(asked) == len(set(asked)) and {"Ġone", "Ġtwo", ","} <= set(asked)


def test_token_files_deal_one_shard_a_task(spark, monkeypatch):
    import public_tokenizers as public

    monkeypatch.setattr(token_files, "PER_SHARD", 4)
    docs, out = spark.range(96).selectExpr("id AS doc_id", "repeat(concat(id, ' word '), 9) AS text"), work_dir(spark, "tokens")
    token_files.write(docs, out, public.path("byte_bpe_50k.json"), end=2)
    files = spark.read.parquet(f"{out}/blocks").groupBy(F.input_file_name().alias("file")).agg(F.collect_set("shard").alias("shards")).collect()
    assert len(files) > 12 and all(len(f["shards"]) == 1 for f in files)
    assert [r["doc"] for r in token_files.read(spark, out).orderBy("start").collect()] == list(range(96))


def test_token_files_hold_small_row_groups(spark, monkeypatch):
    import public_tokenizers as public
    from pyarrow import parquet

    monkeypatch.setattr(token_files, "ROW_GROUP", 1 << 16, raising=False)
    text = " ".join(random.Random(11).choices([f"{a}{b}{c}" for a in "abcdefgh" for b in "aeiou" for c in "lmnrst"], k=8_000))
    docs, out = spark.range(24).selectExpr("id AS doc_id", "id AS n").withColumn("text", F.lit(text)), work_dir(spark, "tokens")
    token_files.write(docs, out, public.path("byte_bpe_50k.json"), end=2, block=1)
    (file,) = Path(out.removeprefix("file:"), "blocks").glob("*.parquet")
    groups = parquet.ParquetFile(file).metadata
    assert groups.num_rows == 24 and groups.num_row_groups > 4
    assert token_files.read(spark, out, checksum=True).select("n_tokens", "crc32").distinct().count() == 1


def test_token_files_encode_in_small_memory():
    import public_tokenizers as public

    rnd, default = random.Random(12), pa.default_memory_pool()
    known = ["".join(rnd.choices("abcdefghij", k=rnd.randrange(2, 9))) for _ in range(3_000)]
    texts = [" ".join(rnd.choices(known, k=350)) for _ in range(7_000)]  # 15 MB
    batches = [pa.record_batch({"doc": list(range(i, i + 250)), "tie": [0] * 250, "text": texts[i : i + 250]}) for i in range(0, 7_000, 250)]
    pa.set_memory_pool(pool := pa.proxy_memory_pool(default))
    try:
        made = [(batch.num_rows, batch.nbytes) for batch in token_files.in_groups(batches, public.path("byte_bpe_50k.json"), 2)]
    finally:
        pa.set_memory_pool(default)
    assert sum(n for n, _ in made) == 7_000 and pool.max_memory() < 60 << 20, pool.max_memory() >> 20


def test_token_files_of_texts_with_added_tokens(spark):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    path, out, rnd = public.path("byte_bpe_50k.json"), work_dir(spark, "tokens"), random.Random(12)
    signs = [*"ab \n\t'é中", "  ", " don't", " <|endoftext|>", "<|endoftext|>", "<|endof"]
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|>  y", "after them"]
    texts += ["".join(rnd.choice(signs) for _ in range(rnd.randrange(0, 30))) for _ in range(60)]
    token_files.write(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), out, path, end=2)
    tokenizer, want, start = Tokenizer.from_file(path), [], 0
    for doc, text in enumerate(texts):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        want.append((doc, start, len(ids), ids))
        start += len(ids)
    assert want[0][3] == [64, 220, 50256, 275, 2]
    assert sorted((tuple(r) for r in token_files.read(spark, out).collect()), key=lambda r: r[1]) == want


def test_jaccard_join(docs, rows, none):
    got = by_id(jaccard_join.joined(docs), "class_id", "n_links", key="id")
    assert got == plain.classes([(r[0], r[1]) for r in rows]) and any(n for _, n in got.values())
    stay = jaccard_join.distinct(docs)
    assert stay.columns == docs.columns
    assert {r.doc_id for r in stay.collect()} - {None} == {i for i, (c, _) in got.items() if i == c}
    assert jaccard_join.joined(none).count() == 0


def test_jaccard_join_of_many_near_copies(spark):
    rnd = random.Random(6)
    bases = [[f"w{rnd.randrange(10**6)}" for _ in range(200)] for _ in range(8)]
    rows = []
    for i in range(160):
        own = list(bases[i % 8])
        for _ in range(rnd.randrange(0, 6)):
            own[rnd.randrange(200)] = f"v{rnd.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    df = jaccard_join.joined(spark.createDataFrame(rows, "doc_id long, text string"))
    assert by_id(df, "class_id", "n_links", key="id") == plain.classes(rows)


def test_runs_meet_pairs_at_the_threshold():
    import math

    met = lambda same, runs: 1 - (1 - same) ** runs
    for similarity in (0.5, 0.8, 0.9):
        at, total = similarity * jaccard_join.TOKENS, 0.0
        for n in range(jaccard_join.least(similarity), jaccard_join.TOKENS + 1):
            alive = 1.0
            for _ in range(jaccard_join.DEPTH):
                alive = 1 - (1 - alive / at) ** n
            chance = math.comb(jaccard_join.TOKENS, n) * similarity**n * (1 - similarity) ** (jaccard_join.TOKENS - n)
            total += chance * met(alive, jaccard_join.runs(similarity))
        assert total >= jaccard_join.RECALL
    rnd, pairs = np.random.default_rng(7), 2000
    one = rnd.integers(0, 1 << 16, (pairs, jaccard_join.TOKENS)).astype(np.uint16)
    two = np.where(rnd.random(one.shape) < 0.8, one, one + np.uint16(1))
    of, path = jaccard_join.leaves(np.concatenate([one, two]), 0.8, jaccard_join.DEPTH, jaccard_join.runs(0.8))
    seen = [set(zip((of[own] % pairs).tolist(), path[own].tolist())) for own in (of < pairs, of >= pairs)]
    found = {i for i, _ in seen[0] & seen[1]} & set(np.flatnonzero((one == two).sum(1) >= jaccard_join.least(0.8)).tolist())
    assert len(found) >= 0.994 * pairs


def test_blocks_meet_in_pairs(spark):
    rows = spark.createDataFrame([(1, i) for i in range(40)] + [(2, 7)] + [(3, i) for i in range(2)], "k long, node long")
    got = jaccard_join.blocks(rows, "k", "node", most=10).collect()
    assert {r.k for r in got} == {1, 3}
    groups = {}
    for r in got:
        groups.setdefault((r.k, r.a, r.b), set()).add(r.node)
    met = {(x, y) for (k, _, _), g in groups.items() if k == 1 for x in g for y in g}
    assert len(met) == 1600 and max(len(g) for g in groups.values()) < 40


def test_connected(spark):
    links = [(i, i + 1) for i in range(20, 60)] + [(1, 5), (9, 5), (70, 70)]
    got = {r.node: r.root for r in jaccard_join.connected(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: 20 for i in range(20, 61)} | {1: 1, 5: 1, 9: 1}


def test_fingerprints(spark, docs, rows, none):
    got = by_id(fingerprints.fingerprinted(docs), "fingerprint")
    texts = {r[0]: r[1] or "" for r in rows}
    assert all(len(f) == 256 for f in got.values())
    for a in texts:
        for b in texts:
            assert (got[a] == got[b]) == (plain.shingles(texts[a]) == plain.shingles(texts[b]))
    pairs = [(got[a], got[b], plain.jaccard(plain.shingles(texts[a]), plain.shingles(texts[b]))) for a in texts for b in texts if plain.words(texts[a]) and a < b]
    df = spark.createDataFrame(pairs, "a string, b string, j double")
    off = [r["x"] - r["j"] for r in df.select(fingerprints.likeness(df.a, df.b).alias("x"), "j").collect()]
    assert max(map(abs, off)) < 0.2 and abs(np.mean(off)) < 0.02
    assert fingerprints.against_next(none).count() == 0


def test_fingerprints_against_next(docs, rows):
    df = fingerprints.against_next(docs)
    assert df.count() == docs.count()
    own = sorted((r[0], r[1] or "") for r in rows)
    for i, (edited, near) in by_id(df, "edited", "near_next", key="id").items():
        k = [x for x, _ in own].index(i)
        text, after = own[k][1], own[(k + 1) % len(own)][1]
        cut = len(text) // 4
        assert edited == text[: len(text) - cut] + after[:cut] and 0 <= near <= 1
    assert [(r.edited, r.near_next) for r in df.where("id IS NULL").collect()] == [("no id here", None)]


def _labelled(spark, n=400):
    rnd = random.Random(9)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 8))) for _ in range(500)]
    rows, labels = [], []
    for i in range(n):
        own = [rnd.choice(vocabulary) for _ in range(rnd.randrange(30, 200))]
        bad, toxic = i % 4 == 0, i % 5 == 0
        if toxic:
            for _ in range(3):
                own.insert(rnd.randrange(len(own)), rnd.choice(["grumblefool", "nastyhead,", "vilespawn"]))
        text = "".join(f"{w.upper()}!! " for w in own) if bad else " ".join(own) + "."
        rows.append((i, text, "en" if i % 2 else "de", "s"))
        labels.append((i, int(not bad), int(toxic)))
    rows += [(n, None, None, None), (None, "", "en", "s"), (n + 1, " \n", "en", "s")]
    labels += [(n, None, None), (0, 0, 1), (None, 1, 0), (10**6, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_classifier(spark, docs, none):
    known, labels = _labelled(spark)
    model = quality_classifier.learnt(quality_classifier.sample(known, labels, "quality"))
    got = quality_classifier.scored(known, model).withColumn("held", quality_classifier.held_out(F.col("doc_id"))).collect()
    assert len(got) == known.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held and r.doc_id is not None and r.doc_id < 400]
    assert len(held) > 40 and all(r.predicted == int(r.doc_id % 4 != 0) for r in held)
    assert quality_classifier.scored(docs, model).count() == docs.count() and quality_classifier.scored(none, model).count() == 0
    untaught = quality_classifier.learnt(quality_classifier.sample(known, labels.limit(0), "quality"))
    assert {r.score for r in quality_classifier.scored(known, untaught).collect()} == {0.5}


def test_toxicity(spark, docs, none):
    known, labels = _labelled(spark)
    categories = toxicity.by_language(known, labels)
    assert list(categories) == ["toxic_de", "toxic_en", "toxic"]
    chain = toxicity.learnt(toxicity.sample(known, labels, categories), tuple(categories))
    assert len(chain.models) == 3 and len(chain.models[2].weights) == len(chain.known) + 2
    got = toxicity.scored(known, chain).collect()
    assert all(r.toxic == (r.doc_id is not None and r.doc_id < 400 and r.doc_id % 5 == 0) for r in got)
    assert toxicity.scored(docs, chain).count() == docs.count() and toxicity.scored(none, chain).count() == 0
    untaught = toxicity.learnt(toxicity.sample(known, labels.limit(0), categories), tuple(categories))
    assert not any(r.toxic for r in toxicity.scored(known, untaught).collect())


def plain_votes(model, texts):
    grid, out = quality_classifier.GRID, []
    known = [[round(float(x) * grid) for x in v] for v in model.vectors]
    for text in texts:
        own = [round(float(x) * grid) for x in model.place(quality_classifier.term_shares([(text or "").encode()]))[0]]
        near = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in enumerate(known))[: quality_classifier.NEIGHBOURS]
        weight = [(max(-c / grid**2, 1e-3) ** quality_classifier.SHARPNESS, model.labels[i]) for c, i in near]
        out.append(sum(w * y for w, y in weight) / sum(w for w, _ in weight))
    return out


def test_quality_votes_equal_plain(spark):
    """The vote of every text against cosines worked out one by one."""
    known, labels = _labelled(spark, 120)
    model = quality_classifier.learnt(quality_classifier.sample(known, labels, "quality"))
    got = [(r.text, r.score) for r in quality_classifier.scored(known, model).collect()]
    assert [s for _, s in got] == pytest.approx(plain_votes(model, [t for t, _ in got]), abs=1e-9)


def plain_chain(chain, text):
    """Probabilities of one text, category after category."""
    seen = Counter(int(h) for h in toxicity.terms([(text or "").encode()])[0])
    x = [math.log(1 + seen[int(k)]) for k in chain.known]
    for model in chain.models:
        z = sum(a * b for a, b in zip(x, model.weights)) + model.bias
        x.append(1 / (1 + math.exp(-min(30, max(-30, z)))))
    return x[len(chain.known) :]


def test_chain_equals_plain(spark):
    known, labels = _labelled(spark)
    categories = toxicity.by_language(known, labels)
    chain = toxicity.learnt(toxicity.sample(known, labels, categories), tuple(categories))
    for r in toxicity.scored(known, chain).collect():
        assert [r.categories[c] for c in categories] == pytest.approx(plain_chain(chain, r.text), abs=1e-6)


def test_training_sees_counts_as_scoring_does():
    texts = [b"vile vile vile word", b"vile other word", b"word word", b"plain words here"] * 3
    found = [toxicity.terms([t])[0] for t in texts]
    own = [np.unique(h, return_counts=True) for h in found]
    labels = np.array([[1], [1], [0], [0]] * 3)
    chain = toxicity.fit([i for i, _ in own], [n for _, n in own], labels, ("toxic",))
    x = chain.counts(texts)
    at = int(np.searchsorted(chain.known, toxicity.terms([b"vile"])[0][0]))
    assert x[0, at] == np.log1p(3) and x[1, at] == np.log1p(1)
    fitted = toxicity.linear(x, labels[:, 0].astype(float))
    assert np.allclose(fitted.weights, chain.models[0].weights)


def test_held_out_follows_the_checksum(spark):
    import zlib

    df = spark.range(50).withColumnRenamed("id", "doc_id")
    for r in df.select("doc_id", quality_classifier.held_out(df.doc_id).alias("h")).collect():
        assert r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


