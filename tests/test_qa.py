"""Answers, records, merges, vocabularies, contracts and turns."""

from __future__ import annotations

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mailspark.functions.jsontext import parse_json, parse_object
from mailspark.operators import contracts as C
from mailspark.operators import model as M
from mailspark.operators import records as N
from mailspark.operators import requests as R
from mailspark.operators import responses as A
from mailspark.operators import turns as U
from mailspark.operators import vocabulary as V

TEXTS = [
    '{"a":1}', '{"a":1} x', "[1] x", "1", "", "  ", ' {"a":[1,{"b":"]"}]} ', '{"a":1,"b":2,"a":{"c":3}}', '{"a":1}],[{"b":2}', '{"a":1}}',
    '```json\n{"a":1}\n```', "{'a':1}", '{"a":1', '{"a":1},{"b":2}', "[]", "[[1],[2]]", '"text"', "null", "true", '{"a":"]x"} ]', "1],[2",
]


def _loads(text):
    try:
        return json.loads(text)
    except ValueError:
        return None


def test_strict_json(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    got = df.select("i", F.to_json(parse_json(F.col("t"))).alias("v"), F.to_json(parse_object(F.col("t"))).alias("o"))
    for row, text in zip(got.orderBy("i").collect(), TEXTS):
        want = _loads(text)
        assert (None if row["v"] is None else json.loads(row["v"])) == want, text
        assert (None if row["o"] is None else json.loads(row["o"])) == (want if isinstance(want, dict) else None), text


def test_key_order_with_repeated_keys(spark):
    df = spark.createDataFrame([('{"b":1,"a":2,"b":3}',)], "t string")
    assert df.select(F.to_json(parse_object(F.col("t")))).first()[0] == '{"b":3,"a":2}'


ANSWERS = {
    '[{"issue":"i"}]': ("ok", 1), '{"items":[{"issue":"i"},3]}': ("ok", 2), '{"qa":[{}]}': ("ok", 1), '{"qas":[{}]}': ("ok", 1),
    '{"data":[{}]}': ("ok", 1), '{"items":3,"qa":[{},{}]}': ("ok", 2), '{"items":[]}': ("no_items", 0), '{"items":[],"qa":[{}]}': ("no_items", 0),
    '{"other":1}': ("no_list", None), "7": ("no_list", None), "null": ("no_list", None), "": ("empty", None), None: ("empty", None),
    '{"items":[{"issue"': ("bad_json", None), '```json\n[]\n```': ("bad_json", None), "[] done": ("bad_json", None), '{"items":"[1]"}': ("no_list", None),
}


def test_extract_items(spark):
    df = spark.createDataFrame(list(enumerate(ANSWERS)), "i int, response string")
    got = A.extract_items(df).select("i", "status", F.size("items").alias("n")).orderBy("i").collect()
    assert [(r["status"], r["n"]) for r in got] == list(ANSWERS.values())


def test_qa_records(spark):
    snippets = ['null', '""', '0', '0.0', 'false', '[]', '{}', '"0"', '1', 'true', '["a"]', '"ls"']
    answer = json.dumps([]) [:-1] + ",".join('{"issue":["x","y"],"category":null,"model":2,"code_snippet":%s}' % s for s in snippets) + ',"junk",{"resolution":"r"}]'
    df = spark.createDataFrame([("f.md", answer)], "doc_key string, response string")
    items = A.explode_items(A.extract_items(df))
    assert items.filter("item_status = 'not_object'").count() == 1
    rows = A.qa_records(items).orderBy("item_no").collect()
    assert [r["code_snippet"] for r in rows] == [""] * 7 + ["0", "1", "true", '["a"]', "ls", ""]
    assert rows[0]["issue"] == '["x","y"]' and rows[0]["category"] is None and rows[0]["model"] == "2"
    assert [r["item_no"] for r in rows] == list(range(12)) + [13]


def test_scrub_answers(spark):
    cases = {
        '{"markdown":"# a\\n"}': ("ok", "# a\n"), '{"markdown":""}': ("ok", ""), '{"markdown":5}': ("no_markdown", None),
        '{"markdown":null}': ("no_markdown", None), '{"md":"x"}': ("no_markdown", None), '["x"]': ("not_object", None),
        '"x"': ("not_object", None), "": ("empty", None), None: ("empty", None), '{"markdown":"a"} b': ("bad_json", None),
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, response string")
    got = A.scrubbed_text(df).orderBy("i").collect()
    assert [(r["status"], r["markdown"]) for r in got] == list(cases.values())


def test_merge_is_right_biased_and_keeps_order(spark):
    rng = random.Random(3)
    values = [None, 1, "x", [1, 2], {"k": "v"}, True, 2.5]
    pairs = [
        ({k: rng.choice(values) for k in rng.sample("abcdef", rng.randint(0, 5))}, {k: rng.choice(values) for k in rng.sample("abcdef", rng.randint(0, 5))})
        for _ in range(300)
    ]
    rows = [(i, json.dumps(b), json.dumps(p)) for i, (b, p) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, b string, response string").withColumn("record", parse_object(F.col("b")))
    got = A.merge_record(df).select("i", F.to_json("record").alias("r")).orderBy("i").collect()
    for row, (base, patch) in zip(got, pairs):
        merged = json.loads(row["r"])
        assert merged == base | patch and list(merged) == list(base | patch)


@pytest.mark.parametrize("answer,status", [(None, "kept_no_answer"), ("", "kept_blank"), (" 　", "kept_blank"), ("[1]", "kept_bad_json"), ("{", "kept_bad_json"), ("{}", "rewritten")])
def test_merge_falls_back(spark, answer, status):
    df = spark.createDataFrame([('{"a":1}', answer)], "b string, response string").withColumn("record", parse_object(F.col("b")))
    row = A.merge_record(df).select("status", F.to_json("record").alias("r")).first()
    assert (row["status"], row["r"]) == (status, '{"a":1}')


def test_requests(spark):
    df = spark.createDataFrame([("a.md", "line {x}\n")], "doc_key string, markdown string")
    for request in (R.scrub_request, R.distil_request):
        system, user = request(df, "Sys {y}").first()["messages"]
        assert (system["role"], system["content"], user["role"]) == ("system", "Sys {y}", "user")
        assert "a.md" in user["content"] and ">\nline {x}\n\n</" in user["content"]
    custom = R.scrub_request(df, "s", template="<{text}|{name}>").first()["messages"][1]["content"]
    assert custom == "<line {x}\n|a.md>"


def test_minimal_record(spark):
    df = spark.createDataFrame([(None, None, "G1", None, "r", None, "extra")], "file string, category string, model string, issue string, resolution string, code_snippet string, more string")
    record = json.loads(df.select(R.minimal_record()).first()[0])
    assert record == {"file": "", "category": None, "model": "G1", "issue": "", "resolution": "r", "code_snippet": ""}


def test_vocabulary(spark):
    cases = {
        "Go2": "Go2", "go2 air": "Go2", "GO2-edu": "Go2 EDU", "Go2 EDUX": "Go2", "go2w": "Go2-W", "b2-w wheel": "B2-W", "B20": None, "xG1": None,
        "人形G1摔倒": "G1", "L2 lidar": "L2 LiDAR", "L2": None, "": None, None: None, "G1 or H1": "G1",
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, t string")
    assert [r["m"] for r in df.select("i", V.normalise_model(F.col("t")).alias("m")).orderBy("i").collect()] == list(cases.values())
    suffixes = df.select("i", V.normalise_model(F.regexp_replace("t", "air", "Air"), keep_suffix=True).alias("m")).orderBy("i").collect()
    assert suffixes[1]["m"] == "Go2 Air" and suffixes[5]["m"] == "B2-W"
    aliased = V.normalise_model(F.lit("my dog"), ["Go2"], aliases={"dog": "Go2"})
    assert df.select(aliased).first()[0] == "Go2"


def test_category(spark):
    df = spark.createDataFrame([(" SDK",), ("misc",), (None,)], "category string")
    assert [(r[0], r[1]) for r in V.normalise_category(df).collect()] == [("sdk", True), ("other", False), ("other", False)]
    texts = spark.createDataFrame([(0, "The motor and the battery overheat"), (1, "相机标定失败 lidar"), (2, "hello"), (3, "import SDK")], "i int, t string")
    assert [r["c"] for r in texts.select("i", V.category_rules(F.col("t")).alias("c")).orderBy("i").collect()] == ["hardware", "sensor", "other", "sdk"]


def test_filter_technical(spark):
    rows = [
        (0, "Please send the invoice.\nThe motor shows an error.\nBest wishes"), (1, "Invoice and payment only."), (2, "Nothing special."),
        (3, "发票请尽快\n电机报错"), (4, "The catalog lists a visa-free route"),
    ]
    got = {r["i"]: r["markdown"] for r in C.filter_technical(spark.createDataFrame(rows, "i int, markdown string")).collect()}
    assert got == {0: "The motor shows an error.", 2: "Nothing special.", 3: "电机报错"}


def test_contract_checks(spark):
    df = spark.createDataFrame(
        [("see https://a.example/x. and (https://b.example/y)", "怎么处理？", "请看 https://b.example/y"), ("", "客户遇到问题", "use it")],
        "src string, issue string, resolution string",
    )
    first, second = C.check_distilled(df, "src").collect()
    assert (first["urls_missing"], first["third_person"], first["is_chinese"]) == (1, False, False)
    assert (second["urls_missing"], second["third_person"], second["is_chinese"]) == (0, True, True)
    links = spark.createDataFrame([("x https://drive.google.com/a?b=1 y https://github.com/z", None, "")], "issue string, resolution string, code_snippet string")
    row = C.replace_share_links(links).first()
    assert row["n_share_links"] == 1 and "drive.google" not in row["issue"] and "https://github.com/z" in row["issue"]


def test_alternative_records(spark):
    answer = '[{"question":"q","answer":"a","product":null,"tags":["WiFi","SDK"],"source_note":"n"},{"question":"q2","tags":"no list"}]'
    df = spark.createDataFrame([("f.md", answer)], "doc_key string, response string")
    rows = N.alternative_records(A.explode_items(A.extract_items(df))).orderBy("item_no").collect()
    assert rows[0]["tags"] == ["WiFi", "SDK"] and rows[1]["tags"] == [] and rows[0]["product"] is None
    qa = N.from_alternative(N.alternative_records(A.explode_items(A.extract_items(df)))).orderBy("item_no").first()
    assert (qa["category"], qa["issue"], qa["resolution"]) == ("WiFi", "q", "a")


def test_split_reply(spark):
    df = spark.createDataFrame([("q\n\n---\n\nReply:\na\n---\n\nReply:\nb",), ("q --- Reply: a",)], "t string")
    question, answer = U.split_reply(F.col("t"))
    got = [tuple(r) for r in df.select(question, answer).collect()]
    assert got == [("q", "a\n---\n\nReply:\nb"), ("q --- Reply: a", None)]


def _pairs(turns):
    out, question = {}, {}
    for conv, turn, role, text in sorted(turns):
        if role == "user":
            question[conv] = turn
            out[conv, turn] = ("question", text, [])
        elif role == "assistant" and conv in question:
            out[conv, question[conv]][2].append(text)
        else:
            out[conv, turn] = ("orphan_answer" if role == "assistant" else "other_role", None, text)
    return {k: (s, i, ("\n\n".join(a) or None, len(a)) if s == "question" else (a, 0)) for k, (s, i, a) in out.items()}


def test_pair_turns(spark):
    rng = random.Random(5)
    turns = [(c, t, rng.choice(["user", "assistant", "assistant", "system"]), f"{c}/{t}") for c in range(20) for t in range(rng.randint(1, 30))]
    turns += [(99, t, "user" if t in (5, 2900) else "assistant", f"long/{t}") for t in range(3000)]
    turns += [(100, 1, "user", "q"), (100, 2, "assistant", "a"), (100, 150_000, "assistant", "far"), (101, 1, "assistant", "first"), (102, 3, None, "nobody")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.status, r.issue, (r.resolution, r.n_answers)) for r in U.pair_turns(df).collect()}
    assert got == _pairs([(c, t, r or "", x) for c, t, r, x in turns])
    assert U.answer_turns(df).count() == len(turns)


@pytest.mark.parametrize("width,levels", [(4, 2), (3, 3), (1000, 1)])
def test_running_max(spark, width, levels):
    rng = random.Random(9)
    rows = [(g, p, rng.choice([None, rng.randint(0, 99)])) for g in range(3) for p in rng.sample(range(200), 90)]
    df = spark.createDataFrame(rows, "g int, p int, v int")
    got = {(r["g"], r["p"]): r["m"] for r in U.running_max(df, ["g"], "p", F.col("v"), "m", width=width, levels=levels).collect()}
    top = {}
    for g, p, v in sorted(rows, key=lambda r: (r[0], r[1])):
        top[g] = max((x for x in (top.get(g), v) if x is not None), default=None)
        assert got[(g, p)] == top[g]


@pytest.mark.parametrize("dedupe", [False, True])
def test_calls_in_flight_are_shared_out_to_tasks(spark, dedupe):
    """Seven calls at once with two threads a task: three tasks, however many partitions there are."""

    def connect():
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        return lambda messages, **_: str(task)

    df = spark.range(200).repartition(16).selectExpr("id", "array(struct('user' AS role, CAST(id AS string) AS content)) AS messages")
    for bound, threads, tasks in ((7, 2, 3), (1, 4, 1), (5, 8, 1)):
        got = M.call_model(df, connect, model="m", in_flight=bound, threads=threads, dedupe=dedupe).collect()
        assert len(got) == 200 and 1 <= len({r.response for r in got}) <= tasks


@pytest.mark.parametrize("how", ["plain", "dedupe", "log"])
def test_bounded_calls_read_bounded_parts(spark, tmp_path, monkeypatch, how):
    """A bound on tasks must not share the whole table out to so few of them."""

    def connect():
        from pyspark import TaskContext

        context = TaskContext.get()
        return lambda messages, **_: f"{context.stageId()} {context.partitionId()}"

    monkeypatch.setattr(M, "PER_TASK", 4_000, raising=False)
    df = spark.range(3000).repartition(30).selectExpr("id", "array(struct('user' AS role, CAST(id AS string) AS content)) AS messages")
    options = {"dedupe": True} if how == "dedupe" else {"log": str(tmp_path / "log")} if how == "log" else {}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or this little table is one part
    try:
        got = M.call_model(df, connect, model="m", in_flight=3, **options).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.id for r in got) == list(range(3000))
    of_task = Counter(r.response for r in got)
    of_stage = Counter(task.split()[0] for task in of_task)
    assert len(of_stage) > 1 and max(of_stage.values()) <= 3 and max(of_task.values()) <= 600
