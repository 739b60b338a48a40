"""Contract checks over documents and QA records: what the prompts promise, measured."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.functions import pii
from mailspark.functions.text import any_word, rstrip

# Topics that make a line commercial, logistic or a mere courtesy.
BUSINESS_WORDS = (
    "quotation", "quote", "invoice", "payment", "wire transfer", "contract", "vat", "refund", "shipping",
    "courier", "tracking number", "customs", "visa", "invitation letter", "holiday", "best wishes",
    "报价", "发票", "付款", "合同", "物流", "快递", "签证", "邀请函", "节日",
)

# Topics that make a line technical.
TECHNICAL_WORDS = (
    "error", "firmware", "driver", "sdk", "api", "motor", "sensor", "lidar", "camera", "imu", "battery",
    "cable", "port", "network", "udp", "tcp", "ros", "timeout", "crash", "calibration", "log", "version",
    "报错", "固件", "驱动", "电机", "传感器", "雷达", "相机", "电池", "网络", "日志", "版本",
)

# Third-person phrases a question or an answer must not use.
THIRD_PERSON = ("建议用户", "用户可以", "用户想知道", "客户想知道", "客户遇到", "客户邮件中提到", "客户说")

# Phrases that point back to the mail a record came from.
MAIL_CONTEXT = ("客户邮件", "邮件往来", "上封邮件", "如前文邮件所示", "如邮件所示", "根据客户邮件", "客户在视频中说")

# A link ends before white space, quotes, closing brackets, Han text and wide punctuation, and
# not on a mark that ends the sentence.
URL = r"https?://[^\s<>\"')\]\p{IsHan}\u3000-\u303f\uff00-\uffef]*[^\s<>\"')\]\p{IsHan}\u3000-\u303f\uff00-\uffef.,;:!?]"
HAN = r"\p{IsHan}"


def drop_business_lines(
    col: Column, business: Sequence[str] = BUSINESS_WORDS, technical: Sequence[str] = TECHNICAL_WORDS
) -> Column:
    """Remove the lines about business that say nothing technical; right trim."""
    pattern = rf"(?im)^(?![^\n]*(?:{any_word(technical)}))(?=[^\n]*(?:{any_word(business)}))[^\n]*+\n?"
    return rstrip(F.regexp_replace(col, "(?d)" + pattern, ""))


def is_technical(col: Column, technical: Sequence[str] = TECHNICAL_WORDS) -> Column:
    return F.coalesce(col, F.lit("")).rlike(f"(?i)(?:{any_word(technical)})")


def filter_technical(
    df: DataFrame,
    col: str = "markdown",
    business: Sequence[str] = BUSINESS_WORDS,
    technical: Sequence[str] = TECHNICAL_WORDS,
) -> DataFrame:
    """Drop business lines, then documents that were about business and keep no technical line."""
    about_business = F.coalesce(F.col(col), F.lit("")).rlike(f"(?i)(?:{any_word(business)})")
    kept = df.filter(~about_business | is_technical(F.col(col), technical))
    return kept.withColumn(col, drop_business_lines(F.col(col), business, technical))


def missing_urls(source: Column, answer: Column) -> Column:
    """Links of the source that are no links of the answer."""

    def links(text: Column) -> Column:
        return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(URL), F.lit(0)))

    return F.array_except(links(source), links(answer))


def has_phrase(col: Column, phrases: Sequence[str]) -> Column:
    return F.coalesce(col, F.lit("")).rlike("|".join(phrases))


def han_share(col: Column) -> Column:
    """Share of Han characters among all characters, 0 for an empty text."""
    text = F.coalesce(col, F.lit(""))
    return F.when(text == "", 0.0).otherwise(F.regexp_count(text, F.lit(HAN)) / F.length(text))


def check_distilled(df: DataFrame, source: str, min_han: float = 0.3) -> DataFrame:
    """Checks of a distilled record against the text it came from."""
    return df.withColumns(
        {
            "urls_missing": F.size(missing_urls(F.col(source), F.col("resolution"))).cast("bigint"),
            "third_person": has_phrase(F.col("issue"), THIRD_PERSON) | has_phrase(F.col("resolution"), THIRD_PERSON),
            "is_chinese": han_share(F.concat_ws("", "issue", "resolution")) >= min_han,
        }
    )


def replace_share_links(df: DataFrame, cols: Sequence[str] = ("issue", "resolution", "code_snippet"), hosts: Sequence[str] = pii.SHARE_HOSTS, phrase: str = pii.SHARE_PHRASE) -> DataFrame:
    """Private share links become a phrase; ``n_share_links`` counts them."""
    pattern = F.lit(pii.share_link_pattern(hosts))
    counted = sum((F.regexp_count(F.coalesce(F.col(c), F.lit("")), pattern) for c in cols), F.lit(0))
    changed = {c: pii.replace_share_links(F.col(c), hosts, phrase) for c in cols}
    return df.withColumns({**changed, "n_share_links": counted.cast("bigint")})


def check_rewritten(df: DataFrame, min_han: float = 0.3) -> DataFrame:
    """Checks of a rewritten record: voice, language, no word about the mail behind it."""
    texts = F.concat_ws("\n", "issue", "resolution")
    return df.withColumns(
        {
            "third_person": has_phrase(texts, THIRD_PERSON),
            "mail_context": has_phrase(texts, MAIL_CONTEXT),
            "is_chinese": han_share(F.concat_ws("", "issue", "resolution")) >= min_han,
        }
    )


def same_keys(before: Column, after: Column) -> Column:
    """True where a rewrite neither lost nor added keys."""
    lost = F.array_except(F.map_keys(before), F.map_keys(after))
    added = F.array_except(F.map_keys(after), F.map_keys(before))
    return (F.size(lost) == 0) & (F.size(added) == 0)
