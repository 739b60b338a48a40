"""HTML to Markdown as one chain of column expressions.

A documented subset (headings, paragraphs, breaks, flat lists, links, images, bold,
italics, code and preformatted blocks, rules, entities).  Of tables the rows stay, with bars between
cells; nested lists lose their depth, and nothing is escaped: this is not a full converter and does not claim to
equal one.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailspark.functions import text

_BLOCKS = (
    "address|article|aside|blockquote|body|center|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|"
    "header|html|main|nav|ol|p|pre|section|table|tbody|tfoot|thead|tr|ul"
)

# The value of an attribute: in double or single quotes, or bare.
_VALUE = r"""\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""

# (pattern, replacement), applied in this order.  An unclosed comment, script, style or title
# runs to the end of the page, as in a browser; so every rule is linear in the page.
RULES: tuple[tuple[str, str], ...] = (
    # what never shows
    (
        r"(?i)<(?:!--[\s\S]*?(?:-->|\z)|script\b[\s\S]*?(?:</script\s*>|\z)|style\b[\s\S]*?(?:</style\s*>|\z)"
        r"|title\b[\s\S]*?(?:</title\s*>|\z)|!doctype[^>]*>)",
        "",
    ),
    # white space of the source means nothing
    (r"[ \t\n\r\f]+", " "),
    # inline marks
    (rf"(?i)<img\b(?=[^>]*? alt ?={_VALUE})(?=[^>]*? src ?={_VALUE})[^>]*+>", "![$1$2$3]($4$5$6)"),
    (rf"(?i)<img\b(?=[^>]*? src ?={_VALUE})[^>]*+>", "![]($1$2$3)"),
    (r"(?i)</?(?:strong|b)(?:\s[^>]*)?>", "**"),
    (r"(?i)</?(?:em|i)(?:\s[^>]*)?>", "*"),
    (r"(?i)</?(?:code|tt|kbd)(?:\s[^>]*)?>", "`"),
    (r"(?i)</?(?:span|font|u|small)(?:\s[^>]*)?>", ""),
    (rf"(?i)<a\b(?=[^>]*? href ?={_VALUE})[^>]*+>([^<]*)</a\s*>", "[$4]($1$2$3)"),
    # cells of a row
    (r"(?i)</t[dh]\s*> ?<t[dh]\b[^>]*>", " | "),
    # line structure
    (r"(?i)<br\b[^>]*>", "\n"),
    (r"(?i)<hr\b[^>]*>", "\n\n---\n\n"),
    (r"(?i)<h1\b[^>]*>", "\n\n# "),
    (r"(?i)<h2\b[^>]*>", "\n\n## "),
    (r"(?i)<h3\b[^>]*>", "\n\n### "),
    (r"(?i)<h4\b[^>]*>", "\n\n#### "),
    (r"(?i)<h5\b[^>]*>", "\n\n##### "),
    (r"(?i)<h6\b[^>]*>", "\n\n###### "),
    (r"(?i)<li\b[^>]*>", "\n- "),
    (rf"(?i)</?(?:{_BLOCKS})(?:\s[^>]*)?>|</h[1-6]\s*>", "\n\n"),
    # all other tags
    (r"</?[A-Za-z][^>]*>", ""),
)

# The ampersand comes last so that nothing is decoded twice; no-break spaces become blanks.
ENTITIES = {name[:-1]: char.replace("\xa0", " ") for name, char in html5.items() if name.endswith(";") and char != "&"} | {"AMP": "&amp;"}


def _code_point(number: Column) -> Column:
    """The character of a code point; U+FFFD for those that are none."""
    valid = ((number > 0) & (number < 0xD800)) | ((number > 0xDFFF) & (number <= 0x10FFFF))
    number = F.when(valid, number).otherwise(F.lit(0xFFFD))
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def _decode(col: Column, pattern: str, prefix: str, char_of) -> Column:
    """Replace each distinct code; a text without codes gives an empty list and stays."""

    def decode(text: Column) -> Column:
        codes = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))
        return F.aggregate(codes, text, lambda acc, n: F.coalesce(F.replace(acc, F.concat(F.lit(prefix), n, F.lit(";")), char_of(n)), acc))

    # The one-element array names the input, which is a long chain, exactly once.
    return F.transform(F.array(col), decode)[0]


def decode_entities(col: Column) -> Column:
    names = F.from_json(F.lit(json.dumps(ENTITIES)), "map<string, string>")
    number = lambda n, base: _code_point(F.conv(F.regexp_replace(n, "^0+(?=.)", ""), base, 10).try_cast("bigint"))
    col = _decode(col, r"&([A-Za-z][A-Za-z0-9]*);", "&", lambda n: F.try_element_at(names, n))
    col = _decode(col, r"&#(\d+);", "&#", lambda n: number(n, 10))
    col = _decode(col, r"&#x([0-9A-Fa-f]+);", "&#x", lambda n: number(n, 16))
    return F.replace(col, F.lit("&amp;"), F.lit("&"))


# Line ends and blanks of preformatted text, kept out of reach of the rules until the end.
_KEPT = {"\n": "\ue000", " ": "\ue001", "\t": "\ue002"}


def _fenced(col: Column) -> Column:
    """Each ``<pre>`` as a fenced block, line by line; an unclosed one runs to the end."""

    def fence(part: Column) -> Column:
        inner = F.regexp_replace(part, r"(?i)</?(?:pre|code)\b[^>]*>", "")
        inner = F.regexp_replace(F.regexp_replace(inner, r"\A[ \t]*\n", ""), r"\s+\z", "")
        inner = F.translate(inner, "".join(_KEPT), "".join(_KEPT.values()))
        line = F.lit(_KEPT["\n"])
        return F.concat(F.lit("<p>```"), line, inner, line, F.lit("```</p>"))

    closed = F.regexp_replace(col, r"(?i)</pre\s[^>]*>", "</pre>")
    parts = F.split(closed, r"(?i)(?=<pre\b)|(?<=</pre>)", -1)
    whole = F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"(?i)\A<pre\b"), fence(p)).otherwise(p)), "")
    return F.when(col.rlike(r"(?i)<pre\b"), whole).otherwise(col)


def html_to_markdown(col: Column) -> Column:
    out = _fenced(text.clean_text(col))
    for pattern, replacement in RULES:
        out = F.regexp_replace(out, pattern, replacement)
    out = decode_entities(out)
    out = F.regexp_replace(out, r" *\n *", "\n")
    out = F.regexp_replace(out, r"\n{3,}", "\n\n")
    out = F.translate(out, "".join(_KEPT.values()), "".join(_KEPT))
    return F.concat(text.strip(out), F.lit("\n"))
