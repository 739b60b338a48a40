"""Closed vocabularies: categories and product models.

A vocabulary is a short list the caller holds in code, so it becomes part of the
expression: no join, no shuffle, and nothing that grows with the data is broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.functions.text import any_word, strip

# The categories a record may have.
CATEGORIES = ("environment", "sdk", "control", "hardware", "sensor", "other")

# The product models a record may name.
MODELS = (
    "Go2", "Go2 EDU", "Go2 Pro", "Go2-W", "Go1", "G1", "H1", "H2", "B1", "B2", "B2-W", "L1 LiDAR", "L2 LiDAR",
)

# Words that speak for a category, for the rule-based stand-in; the order breaks ties.
CATEGORY_WORDS: dict[str, tuple[str, ...]] = {
    "sdk": ("sdk", "api", "compile", "build", "import", "example code", "python", "c++", "接口", "编译", "示例"),
    "environment": ("driver", "install", "network", "wifi", "docker", "ubuntu", "dependency", "firmware", "驱动", "网络", "安装"),
    "sensor": ("camera", "lidar", "imu", "point cloud", "calibration", "相机", "雷达", "标定"),
    "control": ("gait", "controller", "navigation", "remote", "walk", "trajectory", "遥控", "导航", "步态"),
    "hardware": ("motor", "battery", "joint", "cable", "overheat", "charger", "screw", "电机", "电池", "关节"),
}


def normalise_category(df: DataFrame, col: str = "category", allowed: Sequence[str] = CATEGORIES, other: str = "other") -> DataFrame:
    """Categories outside the vocabulary become ``other``; ``category_known`` tells which
    were inside.  Case and surrounding white space do not matter."""
    name = strip(F.lower(F.col(col)))
    known = F.coalesce(name.isin(*allowed), F.lit(False))
    return df.withColumns({col: F.when(known, name).otherwise(other), "category_known": known})


def category_rules(col: Column, words: Mapping[str, Sequence[str]] = CATEGORY_WORDS, other: str = "other") -> Column:
    """Rule-based stand-in for the model's choice: the category with most keyword hits, the
    first of the mapping where several have as many, ``other`` without a hit."""
    lowered = F.lower(F.coalesce(col, F.lit("")))

    def entry(score: Column, rank: int, name: str) -> Column:
        return F.struct(score.alias("score"), F.lit(-rank).alias("rank"), F.lit(name).alias("name"))

    # ``other`` scores nothing but goes first among equals, so it wins only without a hit.
    entries = [entry(F.lit(0), 0, other)]
    for rank, (category, terms) in enumerate(words.items(), start=1):
        entries.append(entry(F.regexp_count(lowered, F.lit(any_word(terms))), rank, category))
    return F.array_max(F.array(*entries))["name"]


#: Words behind a model that name a variant of it.
SUFFIXES = ("Air", "Pro", "Plus", "Max", "EDU", "Lite", "Mini", "Ultra")


def _model_pattern(names: Sequence[str]) -> str:
    """Longest name first; blanks and hyphens in a name may be written either way or left out."""
    spelled = []
    for name in sorted(names, key=lambda n: (-len(n), n)):
        spelled.append("[ -]?".join(re.escape(piece) for piece in re.split(r"[ -]", name)))
    # Atomic: once the longest name fits, no shorter one is tried at the same place.
    return r"(?i)(?<![0-9A-Za-z])((?>(?:" + "|".join(spelled) + r")(?![0-9A-Za-z])))"


def normalise_model(
    col: Column, vocabulary: Sequence[str] = MODELS, keep_suffix: bool = False, aliases: Mapping[str, str] | None = None,
    suffixes: Sequence[str] = SUFFIXES,
) -> Column:
    """The vocabulary's spelling of the first model a text names, null if it names none.

    At one place the longest name wins.  A variant ("Go2 Air") becomes its main model, or
    keeps the variant behind it, one of ``suffixes``, with ``keep_suffix``.
    """
    spellings = {n: n for n in vocabulary} | dict(aliases or {})
    pattern = _model_pattern(list(spellings))
    found = F.regexp_extract(F.coalesce(col, F.lit("")), pattern, 1)
    squeezed = F.regexp_replace(F.lower(found), "[ -]", "")
    table = F.create_map(
        *[F.lit(x) for name, target in spellings.items() for x in (re.sub("[ -]", "", name.lower()), target)]
    )
    model = F.try_element_at(table, squeezed)
    if not keep_suffix:
        return model
    # The same place as the model: the variant is optional, so the first model named is the match.
    variants = "|".join(re.escape(s) for s in suffixes)
    suffix = F.regexp_extract(F.coalesce(col, F.lit("")), pattern + rf"(?:[ -](?-i:({variants}))(?![0-9A-Za-z]))?", 2)
    return F.when(suffix == "", model).otherwise(F.concat_ws(" ", model, suffix))
