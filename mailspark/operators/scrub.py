"""Rule-based scrub, dictionary scrub and the leak audit.

The rules carry out the pattern-shaped part of the scrub contract.  They stand beside the
model stage, they do not equal it: free-form names still need a model or a dictionary.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.functions import pii
from mailspark.functions.pii import DEFAULT_RULES, Rule


def scrub_expression(col: Column, rules: Sequence[Rule] = DEFAULT_RULES, cards: bool = True) -> Column:
    """Fold the rules over a text column; cards go first, they are the longest numbers."""
    out = pii.scrub_cards(col) if cards else col
    for rule in rules:
        out = pii.apply_rule(out, rule)
    return out


#: Stands for a line without anything the rules look for.
_BLANK = "\0"


def _scanned(df: DataFrame, col: str, out: str, rules: Sequence[Rule]) -> DataFrame:
    """Add ``<out>lines``, the lines of a text, and ``out``, the text with each line blanked that no rule can hit.

    One pass with short patterns finds the lines that matter, so that the rules read these alone,
    however many they are.  The line behind an open label is kept with it.  Rules of the caller's own
    read the whole text.
    """
    if not set(rules) <= set(DEFAULT_RULES):
        return df.withColumns({out: F.col(col), f"{out}lines": F.lit(None).cast("array<string>")})
    lines, marks = F.col(f"{out}lines"), F.col(f"{out}marks")
    df = df.withColumn(f"{out}lines", F.split(col, "\n", -1))
    opened = lambda x: F.right(x, F.lit(pii.OPEN_LENGTH)).rlike(pii.OPEN_END)
    found = lambda x: reduce(Column.__or__, [x.contains(t) for t in pii.TRIGGER_TEXTS], x.rlike(pii.TRIGGER))
    df = df.withColumn(f"{out}marks", F.transform(lines, lambda x: F.when(opened(x), 2).when(found(x), 1).otherwise(0)))
    # Named twice, so that Spark does not merge it into the function, where it would be worked out for every line.
    wanted = lambda i: (F.get(marks, i) > 0) | F.coalesce(F.get(marks, i - 1) == 2, F.lit(False))
    kept = F.transform(lines, lambda x, i: F.when(wanted(i), x).otherwise(F.lit(_BLANK)))
    return df.withColumn(out, F.array_join(kept, "\n")).drop(f"{out}marks")


def _whole(col: str, out: str) -> Column:
    """The text again: the blanked lines as they were.  Rules keep the number of lines."""
    lines = F.zip_with(F.split(out, "\n", -1), F.col(f"{out}lines"), lambda new, old: F.when(new == _BLANK, old).otherwise(new))
    return F.when(F.col(f"{out}lines").isNull(), F.col(out)).otherwise(F.array_join(lines, "\n"))


def scrub(df: DataFrame, col: str, rules: Sequence[Rule] = DEFAULT_RULES, cards: bool = True) -> DataFrame:
    """The same over a table, faster: the rules read only the lines that hold something they look for,
    and texts without a digit, an ``@`` or a link skip the rules that need one.

    Each rule is a projection of its own inside one generated loop; Spark does not merge
    them, since each names its input several times.
    """
    needs = {rule.needs: f"_needs{i}" for i, rule in enumerate(rules) if rule.needs}
    names = df.columns
    df = _scanned(df, col, "_scan", rules)
    df = df.withColumns({flag: F.col("_scan").rlike(pattern) for pattern, flag in needs.items()})
    if cards:
        df = df.withColumn("_scan", pii.scrub_cards(F.col("_scan")))
    for rule in rules:
        replaced = pii.apply_rule(F.col("_scan"), rule)
        if rule.needs:
            replaced = F.when(F.col(needs[rule.needs]), replaced).otherwise(F.col("_scan"))
        df = df.withColumn("_scan", replaced)
    return df.withColumn(col, _whole(col, "_scan")).select(*names)


def classify_ips(df: DataFrame, col: str) -> DataFrame:
    """Add the number of private and of public addresses in a text."""
    private = F.regexp_count(F.col(col), F.lit(pii.PRIVATE_IP_PATTERN)).cast("bigint")
    total = pii.count_hits(F.col(col), pii.IP)
    return df.withColumns({"n_private_ip": private, "n_public_ip": total - private})


def scrub_header_names(df: DataFrame, col: str, placeholder: str = "<NAME>") -> DataFrame:
    """Replace the display names of a mail's own From, To and Cc in its text."""
    names = pii.display_names(F.col("from_addr"), F.col("to_addr"), F.col("cc_addr"))
    return df.withColumn(col, pii.replace_names(F.col(col), names, placeholder))


#: Names up to this number are carried to the texts whole; of more, only a filter of fixed size is.
CARRIED = 50_000
#: 64-bit words of that filter at most (a power of two): 8 MB.
FILTER_WORDS = 2**20
_TOKEN = rf"[A-Za-z0-9_]++|\p{{IsHan}}|{pii.WORD_CHAR}++"


def scrub_dictionary(
    df: DataFrame,
    names: DataFrame,
    col: str,
    key: str = "doc_key",
    name_col: str = "name",
    placeholder: str = "<NAME>",
    placeholder_col: str | None = None,
    carried: int = CARRIED,
) -> DataFrame:
    """Replace the names of a dictionary table wherever they stand by themselves.

    ``placeholder_col`` names a column of the dictionary with a placeholder per entry
    (organisations, addresses).  Names and texts are cut by one expression into tokens: words, and
    single characters of Han script.  A bit table of the first tokens of all names, built once, decides
    at which places of a text phrases are formed at all; a phrase is looked up by the hash of its
    tokens.  Signs in and around a name do not count there: the name as it is written decides
    what is replaced.  A name without a letter or digit is none.

    The dictionary is counted first.  Up to ``carried`` names go to the texts as a table of hash
    slots, and no row of text or phrase is shuffled.  A larger one (it may grow with the data) stays
    where it is: phrases that a second bit table lets through meet it in a join, and what they hit comes
    back to the texts by ``key``.  Both ways give the same text.
    """
    mark = F.lit(placeholder) if placeholder_col is None else F.coalesce(F.col(placeholder_col), F.lit(placeholder))
    cleaned = names.select(F.regexp_replace(F.trim(F.col(name_col)), r"\s+", " ").alias("value"), mark.alias("mark"))
    cleaned = cleaned.filter("value <> ''").groupBy("value").agg(F.min("mark").alias("mark"))
    cleaned = cleaned.withColumn("parts", _tokens(F.col("value"))).where(F.size("parts") > 0)
    cleaned = cleaned.select("value", "mark", F.size("parts").alias("n"), F.xxhash64("parts").alias("hash"), F.xxhash64(F.get("parts", F.lit(0))).alias("first"))
    sizes = cleaned.groupBy("n").count().collect()  # one row per number of tokens in a name
    count = sum(r["count"] for r in sizes)
    if not count:
        return df
    words = 1
    while words < min(FILTER_WORDS, count):  # 64 bits a name, as long as the table may grow
        words *= 2
    # Tokens and bit table are each named once, so that Spark works the table into the expression; as a column
    # of the texts it would be copied into every row, at 8 MB each.
    texts = df.withColumn("_tokens", _tokens(F.col(col))).withColumn("_bits", _bit_table(cleaned.select("first"), words).scalar())
    marked = F.transform("_tokens", lambda x: F.struct(x.alias("token"), _has_bit(F.col("_bits"), F.xxhash64(x), words).alias("begins")))
    texts = texts.withColumn("_marked", marked).drop("_tokens", "_bits")
    begins = F.transform("_marked", lambda x, i: F.when(x["begins"], i))
    texts = texts.withColumn("_at", F.filter(begins, lambda i: i.isNotNull())).withColumn("_tokens", F.col("_marked")["token"]).drop("_marked")

    def phrases_of(n: int) -> Column:
        return F.transform(F.filter("_at", lambda i: i + n <= F.size("_tokens")), lambda i: F.xxhash64(F.slice("_tokens", i + 1, n)))

    phrases = [phrases_of(n) for n in sorted(r["n"] for r in sizes)]
    texts = texts.withColumn("_phrases", F.array_distinct(F.concat(*phrases))).drop("_at", "_tokens")
    hit = F.struct(F.length("value").alias("n"), "value", "mark", "hash")
    if count <= carried:
        slots = 2 * words
        table = _array_of(cleaned.groupBy(_slot(F.col("hash"), slots).alias("slot")).agg(F.collect_list(hit).alias("item")), slots)
        texts = texts.withColumn("_table", table.scalar())
        found = F.transform("_phrases", lambda h: F.filter(F.get(F.col("_table"), _slot(h, slots)), lambda e: e["hash"] == h))
        texts = texts.withColumn("_hits", F.flatten(F.filter(found, lambda x: x.isNotNull()))).drop("_table")
        return _named(texts, col, df.columns)
    texts = texts.withColumn("_bits", _bit_table(cleaned.select("hash"), words).scalar())
    texts = texts.withColumn("_phrases", F.filter("_phrases", lambda h: _has_bit(F.col("_bits"), h, words))).drop("_bits")
    # Not "explode": Spark would test whether there are phrases ahead of all, and form them anew for it, many times over.
    hits = texts.select(key, F.explode_outer("_phrases").alias("hash")).join(cleaned, "hash")
    per_text = hits.groupBy(key).agg(F.collect_list(hit).alias("_hits"))
    return _named(df.join(per_text, key, "left"), col, df.columns)


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))


def _named(df: DataFrame, col: str, columns: list[str]) -> DataFrame:
    """Replace what ``_hits`` lists, longest first."""
    hits = F.reverse(F.array_sort("_hits"))
    replaced = pii.replace_names(F.col(col), hits["value"], hits["mark"])
    return df.withColumn(col, F.when(F.size("_hits") > 0, replaced).otherwise(F.col(col))).select(*columns)


def _slot(hash: Column, slots: int) -> Column:
    return hash.bitwiseAND(F.lit(slots - 1)).cast("int")


def _array_of(items: DataFrame, size: int) -> DataFrame:
    """One row with one array: ``item`` at the place ``slot``, null elsewhere.  ``size`` bounds it."""
    every = items.sparkSession.range(size).select(F.col("id").cast("int").alias("slot"))
    rows = every.join(items, "slot", "left").agg(F.array_sort(F.collect_list(F.struct("slot", "item"))).alias("rows"))
    return rows.select(F.transform("rows", lambda x: x["item"]).alias("item"))


def _bit_table(hashes: DataFrame, words: int) -> DataFrame:
    """One row with an array of ``words`` integers, in which each hash has set a bit."""
    hash = F.col(hashes.columns[0])
    bit = F.expr("shiftleft(1L, CAST(hash & 63 AS INT))")
    rows = hashes.select(hash.alias("hash")).groupBy(_slot(F.shiftrightunsigned("hash", 6), words).alias("slot")).agg(F.bit_or(bit).alias("item"))
    return _array_of(rows, words)


def _has_bit(bits: Column, hash: Column, words: int) -> Column:
    word = F.coalesce(F.get(bits, _slot(F.shiftrightunsigned(hash, 6), words)), F.lit(0).cast("bigint"))
    return F.getbit(word, hash.bitwiseAND(F.lit(63)).cast("int")) == 1


def leak_audit(df: DataFrame, before: str, after: str, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Per rule: hits before, hits after, texts with a residue.

    All counters are one global aggregate, unpivoted at the end: one row per task is
    shuffled, whatever the number of texts.  The rules read only the lines that hold something they
    look for, and what several rules need is looked up once per text.
    """
    needs = {rule.needs: i for i, rule in enumerate(rules) if rule.needs}
    df = df.select(F.col(before).alias("before"), F.col(after).alias("after"))
    df = _scanned(_scanned(df, "before", "b", rules), "after", "a", rules).select("b", "a")
    df = df.withColumns({name: F.col(name[1]).rlike(pattern) for pattern, i in needs.items() for name in (f"fb{i}", f"fa{i}")})
    counts, totals, cells = [], [], []
    for i, rule in enumerate(rules):

        def hits(side: str, rule=rule) -> Column:
            found = F.regexp_count(F.col(side), F.lit(rule.pattern)).cast("bigint")
            return F.when(F.col(f"f{side}{needs[rule.needs]}"), found).otherwise(F.lit(0).cast("bigint")) if rule.needs else found

        counts += [hits("b").alias(f"b{i}"), hits("a").alias(f"a{i}")]
        totals += [
            F.coalesce(F.sum(f"b{i}"), F.lit(0)).alias(f"b{i}"),
            F.coalesce(F.sum(f"a{i}"), F.lit(0)).alias(f"a{i}"),
            F.count_if(F.col(f"a{i}") > 0).alias(f"r{i}"),
        ]
        cells.append(
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.col(f"b{i}").alias("hits_before"),
                F.col(f"a{i}").alias("hits_after"),
                F.col(f"r{i}").alias("docs_with_residue"),
            )
        )
    return df.select(*counts).agg(*totals).select(F.inline(F.array(*cells)))
