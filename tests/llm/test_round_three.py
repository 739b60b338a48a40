"""URL filter, centroid clustering and periodic runs against plain versions."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailspark.llm import clustering, periodic_runs, queries, url_filter

URLS = [
    None, "", "no scheme", "http://", "://x.net", "https://A.Example.NET/en/1?x=/y", "http://example.net", "http://badexample.net/en/", "http://net/q",
    "http://u:p@Host.example.com:8080/de/7#z", "http://example.com/de", "http://example.com?/de/", "http://x.org/fr/://y", "http://ÄÖ.org/fr/a",
    "http://10.0.0.1/a", "http://a.b.co.uk/", "http://co.uk/", "http://localhost", "http://x.example.org./fr/1", "HTTP://www.EXAMPLE.org/FR/2", "a" * 5000 + "://b.org/fr/" + "c" * 5000,
]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    stop = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    name, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:stop]), rest[stop:]
    return name, rest[: min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))]


def plain_rule(name, path):
    fits = [t for _, t in url_filter.RULES if (name == t.split("/")[0] or name.endswith("." + t.split("/")[0])) and path.startswith("/" + t.split("/", 1)[1])]
    return max(fits, key=len, default=None)


def test_urls_are_cut_and_ruled(spark):
    rows = [(i, u, "own", "own", "own", None) for i, u in enumerate([*URLS, URLS[5]])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, k string, `a``b` string, bad boolean").repartition(3)
    got = url_filter.judged(pages, url_filter.reputation(pages))
    assert {"page_id", "url", "a`b"} <= set(got.columns) and len(set(got.columns)) == len(got.columns)
    rules = dict((t, v) for v, t in url_filter.RULES)
    for r in got.collect():
        name, path = plain_parts(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (name, path, plain_rule(name, path)), r["url"]
        assert r["verdict"] == rules.get(r["rule"], "allow") and r["a`b"] == "own" and r["n"] == 0
    assert got.count() == len(rows)
    assert url_filter.judged(pages.limit(0), url_filter.reputation(pages.limit(0))).count() == 0


def test_domains(spark):
    names = {"a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.y.example.com:80": ("example.com", "com"), "u@example.com.": ("example.com", "com"),
             "localhost": ("localhost", "localhost"), "10.0.0.1": ("10.0.0.1", "10.0.0.1"), "": ("", ""), "[::1]:80": ("[::1]", "[::1]")}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = df.select("n", url_filter.domain(F.col("n")).alias("d"), url_filter.suffix(F.col("n")).alias("s")).collect()
    assert {r["n"]: (r["d"], r["s"]) for r in got} == names


def plain_reputation(outcomes):
    """outcomes: host to (pages with an outcome, bad ones); hosts of the form label.domain.suffix."""
    levels = [lambda h: h.rsplit(".", 1)[1], lambda h: h.split(".", 1)[1], lambda h: h]
    above = {h: (sum(k for _, k in outcomes.values()) + 0.5) / (sum(n for n, _ in outcomes.values()) + 1) for h in outcomes}
    for key in levels:
        groups = {}
        for h, (n, k) in outcomes.items():
            n0, k0, _ = groups.get(key(h), (0, 0, 0))
            groups[key(h)] = (n0 + n, k0 + k, above[h])
        seen = [(n, k, m) for n, k, m in groups.values() if n]
        together = sum(m * (1 - m) * (n - 1) for n, _, m in seen)
        r = (sum(n * (k / n - m) ** 2 for n, k, m in seen) - sum(m * (1 - m) for _, _, m in seen)) / together if together else 0
        strength = url_filter.STRONGEST if r <= 1 / (url_filter.STRONGEST + 1) else max(url_filter.WEAKEST, 1 / r - 1)
        mean = {g: (k + strength * m) / (n + strength) for g, (n, k, m) in groups.items()}
        above = {h: mean[key(h)] for h in outcomes}
    return {h: (above[h], above[h] - url_filter.BOUND * math.sqrt(above[h] * (1 - above[h]) / (outcomes[h][0] + strength + 1))) for h in outcomes}


def test_reputation_equals_plain_and_blocks_bad_hosts(spark):
    rnd = random.Random(2)
    share = {"x.bad.com": 0.95, "y.bad.com": 0.9, "z.bad.com": 0.97, "a.good.com": 0.05, "b.good.com": 0.1, "c.some.org": 0.2, "d.some.org": 0.3, "e.one.org": 0.1}
    rows = [(f"http://{h}/p{i}", rnd.random() < p) for h, p in share.items() for i in range(rnd.randrange(20, 90))]
    rows += [("http://new.bad.com/p", None), ("http://new.good.com/p", None), ("http://a.good.com/q", None)]
    pages = spark.createDataFrame(rows, "url string, bad boolean").repartition(4)
    outcomes = {}
    for u, bad in rows:
        n, k = outcomes.get(plain_parts(u)[0], (0, 0))
        outcomes[plain_parts(u)[0]] = (n + (bad is not None), k + bool(bad))
    hosts = url_filter.reputation(pages)
    got = {r["host"]: (r["rate"], r["lower"]) for r in hosts.collect()}
    want = plain_reputation(outcomes)
    assert got.keys() == want.keys()
    assert all(np.allclose(got[h], want[h], rtol=1e-9) for h in want)
    verdicts = {r["host"]: r["verdict"] for r in url_filter.judged(pages, hosts, rules=[]).collect()}
    assert {h for h, v in verdicts.items() if v == "block"} >= {"x.bad.com", "y.bad.com", "z.bad.com"}
    assert all(v == "allow" for h, v in verdicts.items() if "bad" not in h)
    assert got["new.bad.com"][0] > 0.6 > got["new.good.com"][0]  # a host without outcomes has its domain's mean


def plain_clusters(rows, size=64, clusters=16, rounds=3):
    kept = [(i, [math.floor(64 * x) if abs(x) < 1e300 else int(x) * 64 for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:clusters]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min((far(v, c), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(own[n]) for x in zip(*own[n])] if n in own else c for n, c in enumerate(centroids)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = [sum(d for _, d, n in found if n == c) for c in range(len(centroids))]
    top = 2**63 - 1
    return sorted((repr(i), c, min(d, top), min(inertia[c], top), min(sum(inertia), top), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, d, c in found)


def _clustered(spark, rows, kind="float"):
    vectors = spark.createDataFrame([(i, v, "own", "own") for i, v in rows], f"vec_id long, embedding array<{kind}>, cluster string, row string").repartition(4)
    df = clustering.clustered(vectors)
    assert {"vec_id", "row", "embedding"} <= set(df.columns) and len(set(df.columns)) == len(df.columns)
    return sorted((repr(r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in df.collect())


def test_clusters_equal_plain(spark):
    rnd = np.random.default_rng(1)
    vectors = [[float(np.float32(x)) for x in rnd.normal(0, 0.3, 64) + rnd.integers(-2, 3)] for _ in range(300)]
    rows = list(enumerate(vectors))
    rows += [(300, vectors[7]), (7, vectors[7]), (301, [0.0] * 64), (302, [0.0] * 64), (None, vectors[9])]  # ties, repeated rows, no key
    rows += [(400, None), (401, []), (402, [1.0] * 63), (403, [1.0] * 65), (404, [math.nan] * 64), (405, [math.inf] * 64), (406, [None] * 64)]
    assert _clustered(spark, rows) == plain_clusters(rows)


def test_clusters_of_few_equal_and_huge_vectors(spark):
    for rows, kind in (
        ([(1, [0.5] * 64), (2, [0.5] * 64), (3, [-0.5] * 64)], "float"),
        ([(i, [float(i * 10**k) for k in range(64)]) for i in range(-9, 12)], "double"),
        ([(1, [1.7e308] * 64), (2, [-1.7e308] * 64), (3, [0.0] * 64)], "double"),
        ([], "float"),
        ([(1, None)], "float"),
    ):
        assert _clustered(spark, rows, kind) == plain_clusters(rows)


def test_threshold_algorithm_equals_all_distances():
    rnd = np.random.default_rng(5)
    for _ in range(50):
        points, vectors = rnd.integers(-3, 4, (rnd.integers(1, 12), 5)), rnd.integers(-4, 5, (200, 5))
        cluster, far = clustering.Centroids(tuple(map(tuple, points.tolist()))).nearest(vectors)
        all_far = ((vectors[:, None] - points[None]) ** 2).sum(2)
        assert (cluster == all_far.argmin(1)).all() and (far == all_far.min(1)).all()


def plain_runs(words, least=6, times=4):
    out = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def _periodic_texts():
    rnd = random.Random(4)
    texts = []
    for _ in range(150):
        words = []
        for _ in range(rnd.randrange(0, 7)):
            base = [rnd.choice("abcdefgh"[: rnd.randrange(1, 9)]) for _ in range(rnd.randrange(1, 12 if rnd.random() < 0.8 else 40))]
            words += (base * rnd.randrange(1, 9))[: None if rnd.random() < 0.5 else -1]
            words += [rnd.choice("xyz")] * (rnd.random() < 0.3)
        texts.append(rnd.choice([" ", "\n", " \t\x0b"]).join(words))
    texts += [None, "", " \n ", "a", "a " * 5, "a " * 6, "a b " * 3, "a b " * 4, ("a " * 50 + "c ") * 20, ("a " * 300 + "c " + "a " * 300), "é ü " * 7, "x" * 20_000 + " y" * 9, " ".join(str(i % 700) for i in range(3000))]
    return texts + texts[:5]


def test_periodic_runs_equal_plain(spark):
    texts = _periodic_texts()
    docs = spark.createDataFrame([(i, t, "own", "own") for i, t in enumerate(texts)], "doc_id long, text string, runs string, row string").repartition(3)
    df = periodic_runs.found(docs)
    assert sorted(df.columns) == sorted(["doc_id", "text", "row", "words", "runs", "collapsed"])
    got = df.collect()
    assert len(got) == len(texts) and sum(len(r["runs"]) for r in got) > 300
    for r in got:
        words = [w.decode() for w in (r["text"] or "").encode().split()]
        want = plain_runs(words)
        assert (r["words"], [tuple(x) for x in r["runs"]]) == (len(words), want)
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert r["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone)
    assert periodic_runs.found(docs.limit(0)).count() == 0


def test_transform_gives_exact_mismatches():
    rnd = np.random.default_rng(1)
    for b in (1, 2, 8, 64):
        blocks, windows = rnd.integers(1, 10**6, (5, b)).astype(np.uint64), rnd.integers(0, 10**6, (5, 2 * b)).astype(np.uint64)
        want = [[sum((int(blocks[i, t]) - int(windows[i, k + t])) ** 2 for t in range(b)) % periodic_runs.PRIME for k in range(b)] for i in range(5)]
        assert periodic_runs.mismatches(blocks, windows).tolist() == want


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t) for i, t in enumerate(_periodic_texts())] + [(None, "a b " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{out}/documents.parquet")
    return out


def test_periodic_query_equals_plain(spark, folder):
    import zlib

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.QUERIES["op12_periodic_runs"](spark, folder).collect()}
    assert got.keys() == texts.keys()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    made = 0
    for i, text in texts.items():
        words = [w.decode() for w in (text or "").encode().split()]
        h = None if i is None else zlib.crc32(str(i).encode())
        if h is not None and h % 10 == 0 and words:
            g, n, made = h // 10, len(words), made + 1
            a = g % n
            words = [words[k] if k < a else words[a + (k - a) % (1 + (n - a) // (3 + g % 8))] for k in range(n)]
        found = plain_runs(words)
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        gone = {k for s, n, q in found for k in range(s + q, s + n)}
        r = got[i]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(found), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
        assert r["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in found))
        assert r["collapsed_sha256"] == sha(" ".join(w for k, w in enumerate(words) if k not in gone))
    assert made > 5


def test_toxicity_driver_sees_only_known_terms(spark, monkeypatch):
    """What comes to the driver is bounded by the terms that the models know, not by those of the sample."""
    from mailspark.llm import toxicity

    texts = [(" ".join(f"w{i}x{j}" for j in range(300)) + (" vile scum" if i % 4 == 0 else " kind"), [int(i % 4 == 0)]) for i in range(40)]
    df = spark.createDataFrame(texts, "text string, labels array<int>")
    seen, collect = [], type(df).collect

    def watched(self):
        rows = collect(self)
        seen.append(sum(len(v) for r in rows for v in r if isinstance(v, (bytes, bytearray))))
        return rows

    monkeypatch.setattr(type(df), "collect", watched)
    chain = toxicity.learnt(df, ("toxic",))
    assert sum(seen) < 100_000  # all terms of the sample: 40 texts, 300 words, 16 bytes a term at least
    own = []
    for text, _ in texts:
        h, _ = toxicity.terms([text.encode()])
        own.append(np.unique(h, return_counts=True))
    plain = toxicity.fit([i for i, _ in own], [n for _, n in own], np.array([mark for _, mark in texts]), ("toxic",))
    assert len(chain.known) and np.array_equal(chain.known, plain.known)
    few = toxicity.learnt(df.limit(0), ("toxic",))
    assert not len(few.known) and few.predict(np.zeros((1, 0)))[0, 0] < 0.5
