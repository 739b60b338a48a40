"""The stages of the pipeline and its run against the plain versions, on a small table."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

import corpus_pipeline
from mailspark.llm import mixing, quality_rules
from mailspark.llm.common import packed
from tests.llm import plain

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _rows():
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choice("abcdeéß") for _ in range(rnd.randrange(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n)) + "."
    base, first, second = prose(150), prose(30), prose(35)
    near = base.split(" ")
    near[40] = "changed"
    texts = [None, "", "short", base, " ".join(near), base, f"{first}\n{second}", f"{prose(60)}\n{first}\n{second}\n\n{prose(9)}", f"{first}\n\n{second}"]
    texts += [prose(rnd.randrange(60, 200)) for _ in range(25)]
    rows = [(i * 2, t, "en", None if i % 5 == 0 else f"s{i % 3}", None if i == 6 else len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[10], rows[6], (None, prose(80), None, "s1", 7), (None, None, None, None, None)]


def lines(rows):
    own = [r for r in rows if r[0] is not None]
    cut = plain.lines(list({r[0]: r[1] for r in own}.items()))
    out = []
    for r in rows:
        text = r[1] if r[0] is None else cut[r[0]]
        if text == r[1]:
            out.append(r)
        elif plain.words(text):
            out.append((r[0], text, *r[2:4], len(text)))
    return out


def near_copies(rows):
    classes = plain.classes(list({r[0]: r[1] for r in rows if r[0] is not None}.items()))
    return [r for r in rows if r[0] is None or classes[r[0]][0] == r[0]]


@pytest.mark.parametrize("rows", [_rows(), []], ids=["rows", "empty"])
def test_pipeline(spark, tmp_path, rows):
    import base64

    import public_tokenizers as public
    import tiktoken

    path = public.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    table = lambda x: spark.createDataFrame(x, SCHEMA)
    collected = lambda df: list(map(tuple, df.collect()))

    # The estimate of the rules and the choice of the mix have no plain form: their own columns say what stays.
    judged = quality_rules.judged(table(rows)).where("kept")
    want = collected(judged.select(*table([]).columns))
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = want
        got = stage(spark, table(before if i else rows), str(tmp_path))
        if i in (1, 2):
            want = (lines, near_copies)[i - 1](before)
        elif i == 3:
            docs = table(before)
            mix = mixing.mix(docs.withColumn("row", packed(docs)), ["row"]).collect()
            want = [tuple(r["row"]) for r in mix for _ in range(r["times"])]
        elif i == 4:
            sha = lambda x: hashlib.sha256(x).hexdigest()
            want = []
            for doc, text, _, source, _ in before:
                ids = coder.encode_ordinary(text or "")
                want.append((doc, source, ids, len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode())))
        assert got.columns == (list(table([]).columns) if i < 4 else ["doc_id", "source", "ids", "n_tokens", "ids_sha256", "decoded_sha256"])
        assert Counter(map(repr, collected(got))) == Counter(map(repr, want))
        if rows and i in (1, 2):
            assert want != before
    assert Counter(map(repr, collected(corpus_pipeline.run(spark, str(tmp_path))))) == Counter(map(repr, want))
