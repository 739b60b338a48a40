"""Quality rules by weak supervision: rules vote good, bad or abstain; expectation-maximisation
estimates how often each is right; the posterior probability of a good text decides.

Everything per document is a column expression.  The estimate needs only how many documents
show each combination of votes: at most 3 ** len(RULES) rows, whatever the size of the input.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import SPACE, narrowed, packed, unpacked, words, written

SYMBOLS = r"[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bangs")


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains.  Both are
    SQL conditions over MEASURES."""

    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        return F.expr(f"CASE WHEN {self.bad} THEN -1 WHEN {self.good} THEN 1 ELSE 0 END")


RULES = (
    Rule("length", "n_words < 50", "n_words >= 100"),
    Rule("word_length", "word_chars < 2.5 * n_words OR word_chars > 12 * n_words", "word_chars BETWEEN 3 * n_words AND 9 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines", "n_lines > 1 AND n_dup_lines = 0"),
    Rule("repeated_words", "100 * n_repeat_words > 25 * n_words", "100 * n_repeat_words <= 8 * n_words"),
    Rule("capitals", "100 * n_upper > 40 * word_chars", "100 * n_upper <= 15 * word_chars"),
    Rule("exclamations", "10 * n_bangs > n_words", "50 * n_bangs <= n_words"),
)

BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the input columns) and MEASURES of every whole text; null counts as empty.

    Words of a repeated window: windows of three words are sorted by a 64-bit hash whose low
    bits, as many as the word count has, give way to the position.  Windows of one hash are
    neighbours then; each is compared with the next two word by word, so that windows that only
    share a hash do not count, and one of them between two equal ones does not part those.  The
    words that equal windows cover are counted once.
    """
    df = docs.select(packed(docs), F.coalesce(docs[text], F.lit("")).alias("text"))
    df = df.select("row", "text", words(F.col("text")).alias("w"), F.split("text", "\n", -1).alias("l"))
    df = df.select(
        "row", "text", "w", F.size("w").alias("n"),
        F.filter("l", lambda x: x.rlike(SPACE.replace("[", "[^"))).alias("l"),
        F.expr("-shiftleft(1L, length(bin(size(w))))").alias("high"),
    )
    window = "(xxhash64(w[i], w[i + 1], w[i + 2]) & high) | CAST(i AS BIGINT)"
    df = df.withColumn("keys", F.expr(f"sort_array(IF(n >= 3, transform(sequence(0, n - 3), i -> {window}), CAST(array() AS array<bigint>)))"))
    for name, step in (("twins", 1), ("next", 2)):
        a, b = "CAST(keys[i] & ~high AS INT)", f"CAST(keys[i + {step}] & ~high AS INT)"
        same = " AND ".join([f"((keys[i] ^ keys[i + {step}]) & high) = 0L"] + [f"w[{a} + {j}] = w[{b} + {j}]" for j in range(3)])
        pairs = f"filter(sequence(0, n - {3 + step}), i -> {same})"
        ends = f"array_union(transform({{0}}, i -> keys[i] & ~high), transform({{0}}, i -> keys[i + {step}] & ~high))"
        df = df.withColumn(name, F.expr(f"IF(n >= {3 + step}, {pairs}, CAST(array() AS array<int>))")).withColumn(name, F.expr(ends.format(name)))
    df = df.withColumn("at", F.expr("sort_array(array_union(twins, next))"))
    covered = "aggregate(transform(at, (p, i) -> least(3L, coalesce(get(at, i + 1) - p, 3L))), 0L, (a, x) -> a + x)"
    whole = lambda c: c.cast("long")
    return df.select(
        "row",
        whole(F.col("n")).alias("n_words"),
        whole(F.length(F.array_join("w", ""))).alias("word_chars"),
        whole(F.regexp_count("text", F.lit(SYMBOLS))).alias("n_symbols"),
        whole(F.size("l") - F.size(F.array_distinct("l"))).alias("n_dup_lines"),
        whole(F.expr(covered)).alias("n_repeat_words"),
        whole(F.size("l")).alias("n_lines"),
        whole(F.regexp_count("text", F.lit(r"\p{Lu}"))).alias("n_upper"),
        whole(F.length("text") - F.length(F.replace("text", F.lit("!"), F.lit("")))).alias("n_bangs"),
    )


@dataclass(frozen=True)
class Model:
    """Prior of a good text, and how often each rule's vote is right."""

    prior: float
    accuracy: tuple[float, ...]

    def posterior(self, votes: list[Column]) -> Column:
        score = F.lit(math.log(self.prior / (1 - self.prior)))
        for vote, a in zip(votes, self.accuracy):
            score = score + vote * F.lit(math.log(a / (1 - a)))
        return 1 / (1 + F.exp(-score))


def estimate(patterns: list[tuple[tuple[int, ...], int]], rules: int, rounds: int = 200) -> Model:
    """Expectation-maximisation over (votes, documents with them).

    Each rule errs independently of the others, given the truth, as often on good as on bad
    texts.  All start at 0.8; bounds keep a vote from counting against itself or alone
    deciding.  Without documents the start values stay.
    """
    prior, accuracy = 0.8, [0.8] * rules
    for _ in range(rounds if patterns else 0):
        weights = [math.log(a / (1 - a)) for a in accuracy]
        right, cast, good, total = [0.0] * rules, [0] * rules, 0.0, 0
        for votes, n in patterns:
            score = math.log(prior / (1 - prior)) + sum(v * x for v, x in zip(votes, weights))
            p = 1 / (1 + math.exp(-score))
            good, total = good + n * p, total + n
            for j, v in enumerate(votes):
                if v:
                    cast[j] += n
                    right[j] += n * (p if v > 0 else 1 - p)
        new = [min(0.98, max(0.55, r / c)) if c else a for r, c, a in zip(right, cast, accuracy)]
        moved = max([abs(x - y) for x, y in zip(new, accuracy)], default=0.0)
        prior, accuracy = min(0.98, max(0.02, good / total)), new
        if moved < 1e-9:
            break
    return Model(prior, tuple(accuracy))


def judged(docs: DataFrame, text: str = "text", columns: list[str] | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The input columns (or those named), MEASURES, ``base_failed``, ``votes``, ``p_good`` and
    ``kept``.

    Null or empty texts have no words and fail the base rule.  Repeated rows are judged alike,
    each counted once in the estimate.  Result columns replace input columns of their name.
    """
    columns = docs.columns if columns is None else columns
    df = measured(docs, text)
    df = written(df.withColumn("row", narrowed(columns)))
    votes = F.array(*[r.vote() for r in rules])
    counts = df.groupBy(votes.alias("votes")).count().collect()  # at most 3 ** len(rules) rows
    model = estimate([(tuple(r["votes"]), r["count"]) for r in counts], len(rules))
    failed = F.expr(BASE_FAILED)
    df = df.withColumn("votes", votes)
    df = df.withColumn("p_good", model.posterior([F.col("votes")[j] for j in range(len(rules))]))
    results = {c: F.col(c) for c in MEASURES}
    results |= {"base_failed": failed, "votes": F.col("votes"), "p_good": F.col("p_good"), "kept": ~failed & (F.col("p_good") >= 0.5)}
    return unpacked(df, columns, results)


def passed(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are kept, in their own columns."""
    df = judged(docs.withColumn("__row", packed(docs)), text, ["__row"]).where("kept")
    return df.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])
