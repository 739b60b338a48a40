"""Column functions for line-oriented text clean-up.

Everything here is a plain Column expression (``regexp_replace``, ``rtrim``,
``replace``), so it stays inside whole-stage code generation; no function
splits a document into an array of lines.

Two conventions hold throughout:

* White space is the Unicode set below, not the ASCII ``\\s`` of Java regexes.
* A marker pattern describes ONE line.  ``\\s`` and ``.`` in it never cross a
  line feed, ``^`` / ``$`` are the line's own borders.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space set, by rule: every BMP character up to U+3000 that counts as space.
WS_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def _char_set(chars: str) -> str:
    """Inside of a character class, neighbours written as one range: a regex engine tests a
    class member by member."""
    points, ranges = sorted(map(ord, chars)), []
    for point in points:
        if ranges and ranges[-1][1] == point - 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "".join(f"\\x{{{a:x}}}" + (f"-\\x{{{b:x}}}" if b > a else "") for a, b in ranges)


WS = _char_set(WS_CHARS)
"""Inside of a regex character class: all white space."""

HSPACE = _char_set(WS_CHARS.replace("\n", ""))
"""Inside of a regex character class: white space that does not end a line."""

# Line patterns that open quoted history.
QUOTE_MARKERS = (
    r"^From:\s",
    r"^To:\s",
    r"^Cc:\s",
    r"^Date:\s",
    r"^Subject:\s",
    r"^-----Original Message-----\s*$",
    r"^On .+ wrote:\s*$",
    r"^在.+写道[:：]\s*$",
    r"^发件人[:：]\s*",
    r"^发送时间[:：]\s*",
    r"^收件人[:：]\s*",
    r"^主题[:：]\s*",
)

# Line patterns that open a signature.
SIGNATURE_MARKERS = (
    r"^--\s*$",
    r"^--\s",
    r"^(Kind regards|Kind Regards|Best regards|Best Regards|Regards|Sincerely)[,]?\s*$",
    r"^谢谢[!！]?\s*$",
    r"^此致[，,]?\s*敬礼\s*$",
)

# Second-pass markers of forwarded mail (case-sensitive).
FORWARD_MARKERS = (
    r"^[-]{5,}\s*转发的邮件信息[-\s]*$",
    r"^[-]{5,}\s*Forwarded message[-\s]*$",
    r"^发件人[:：]",
    r"^收件人[:：]",
    r"^抄送人[:：]",
    r"^主题[:：]",
    r"^日期[:：]",
)

# Second-pass markers of signatures (case-insensitive).  Markers that
# name one person or one company are the caller's own and go in by parameter.
CONTACT_MARKERS = (
    r"^Kind Regards\s*$",
    r"^Best Regards\s*$",
    r"^Regards\s*$",
    r"^谢谢[!！]?\s*$",
    r"^此致[，,]?\s*敬礼\s*$",
    r"^Office:\s*\+?\d",
    r"^Mobile:\s*\+?\d",
    r"^WhatsApp:\s*\+?\d",
    r"^WeChat:\s*",
    r"^Email:\s*support_",
)


def rstrip(col: Column) -> Column:
    """Right trim of the Unicode white space set."""
    return F.rtrim(col, F.lit(WS_CHARS))


def strip(col: Column) -> Column:
    """Trim of the Unicode white space set on both sides."""
    return F.trim(col, F.lit(WS_CHARS))


def is_blank(col: Column) -> Column:
    """True where the text holds nothing but white space (null counts as blank)."""
    return ~F.coalesce(col.rlike(f"[^{WS}]"), F.lit(False))


def normalise_newlines(col: Column) -> Column:
    """CRLF and CR become LF, NUL goes away."""
    return F.replace(F.regexp_replace(col, r"\r\n?", "\n"), F.lit("\x00"), F.lit(""))


def drop_trailing_blanks(col: Column) -> Column:
    """Remove blanks and tabs in front of a line feed; the last line is left alone."""
    # The look-behind stands after the first blank, so other characters fail on that alone.
    return F.regexp_replace(col, r"[ \t](?<![ \t][ \t])[ \t]*+\n", "\n")


def clean_text(col: Column) -> Column:
    return drop_trailing_blanks(normalise_newlines(col))


def _in_line(pattern: str, trimmed: bool) -> str:
    """Rewrite a one-line pattern so that it can run over a whole document."""
    out, in_class, i = [], False, 0
    while i < len(pattern):
        pair = pattern[i : i + 2]
        if pair == r"\s":
            out.append(HSPACE if in_class else f"[{HSPACE}]")
        elif pair == r"\d":
            out.append(r"\p{Nd}")
        elif pair.startswith("\\"):
            out.append(pair)
        else:
            char = pattern[i]
            in_class = (in_class or char == "[") and char != "]"
            if trimmed and not in_class and char == "^":
                char = f"^[{HSPACE}]*+"
            elif trimmed and not in_class and char == "$":
                char = f"[{HSPACE}]*+$"
            out.append(char)
            i += 1
            continue
        i += 2
    return "".join(out)


def any_marker(markers: Sequence[str], ignore_case: bool = False, trimmed: bool = False) -> str:
    """One alternation for a list of line patterns (to be used under ``(?dm)``)."""
    flags = "iu" if ignore_case else ""
    return f"(?{flags}:" + "|".join(f"(?:{_in_line(m, trimmed)})" for m in markers) + ")"


def cut_at(col: Column, marker: str, guard: bool) -> Column:
    """Drop everything from the first marker line on.

    ``guard`` asks for a non-blank line above the marker.  The first alternative takes the
    text down to the first non-blank line and puts it back, so the search for markers begins
    below it; everywhere else it fails on its anchor.  The text is read once.
    """
    if guard:
        head = rf"(\A[{WS}]*+[^\n]++(?:\n|\z))"
        return F.regexp_replace(col, rf"(?dm){head}|^{marker}[\s\S]*+\z", "$1")
    return F.regexp_replace(col, rf"(?dm)^{marker}[\s\S]*+\z", "")


def _cut_quoted(col: Column, markers: Sequence[str]) -> Column:
    return cut_at(col, any_marker(markers, ignore_case=True), guard=True)


def _cut_signature(col: Column, markers: Sequence[str]) -> Column:
    return cut_at(col, any_marker(markers, trimmed=True), guard=True)


def strip_quoted(col: Column, markers: Sequence[str] = QUOTE_MARKERS) -> Column:
    """Keep what stands above the first quote marker; markers are matched without case
    on the untrimmed line."""
    return rstrip(_cut_quoted(col, markers))


def strip_signature(col: Column, markers: Sequence[str] = SIGNATURE_MARKERS) -> Column:
    """Keep what stands above the first signature marker; markers are matched with case
    on the trimmed line."""
    return rstrip(_cut_signature(col, markers))


def postprocess(
    col: Column,
    quoted: bool = True,
    signature: bool = True,
    quote_markers: Sequence[str] = QUOTE_MARKERS,
    signature_markers: Sequence[str] = SIGNATURE_MARKERS,
) -> Column:
    """Clean, cut quoted history, cut the signature, right trim.  Each cut can be off.

    A marker line is never blank, so one right trim at the end equals a trim per step.
    """
    out = clean_text(col)
    if quoted:
        out = _cut_quoted(out, quote_markers)
    if signature:
        out = _cut_signature(out, signature_markers)
    return rstrip(out)


def forward_or_contact(
    forward: Sequence[str] = FORWARD_MARKERS, contact: Sequence[str] = CONTACT_MARKERS
) -> str:
    """The second-pass marker: forward lines with case, contact lines without."""
    return f"(?:{any_marker(forward)}|{any_marker(contact, ignore_case=True)})"


def cut_forwarded(
    col: Column,
    forward: Sequence[str] = FORWARD_MARKERS,
    contact: Sequence[str] = CONTACT_MARKERS,
) -> Column:
    """Second-pass cut.  No guard: a hit on the first line leaves an empty document.
    A document with a hit loses its trailing blank lines and ends with one line feed,
    a document without a hit stays as it is."""
    marker = forward_or_contact(forward, contact)
    kept = cut_at(col, marker, guard=False)
    # Only whole blank lines go; blanks at the end of the last kept line stay.
    content = rstrip(kept)
    tail = F.substring_index(F.substr(kept, F.length(content) + 1), "\n", 1)
    kept = F.when(content == "", "\n").otherwise(F.concat(content, tail, F.lit("\n")))
    return F.when(col.rlike(rf"(?dm)^{marker}"), kept).otherwise(col)


_TERMINATOR = r"\r\n|[\n\r\x{b}\x{c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"


def oneline(col: Column) -> Column:
    """Squeeze to one line: terminators become one blank each, a final one leaves nothing,
    null becomes the empty string."""
    body = F.regexp_replace(F.coalesce(col, F.lit("")), rf"(?:{_TERMINATOR})\z", "")
    return F.regexp_replace(body, _TERMINATOR, " ")


def any_word(words: Sequence[str]) -> str:
    """One pattern for a word list: ASCII words stand alone, others may stand inside running
    text.  A look at the first letter spares most places the alternatives."""
    plain = [w for w in words if w.isascii()]
    parts = [re.escape(w) for w in words if not w.isascii()]
    if plain:
        firsts = "".join(sorted({re.escape(w[0]) for w in plain}))
        listed = "|".join(re.escape(w) for w in plain)
        parts.insert(0, rf"(?=[{firsts}])(?<![0-9A-Za-z_])(?:{listed})(?![0-9A-Za-z_])")
    return "(?:" + "|".join(parts) + ")"
