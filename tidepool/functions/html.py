"""Regex-level HTML helpers (tier (a) of page extraction).

They work on closed-tag patterns only, are built from Spark built-ins, and
have DuckDB twins in the oracle. Tier (b), a real tag walker for nested
site rules, lives in ``tidepool.operators.html_extract``.
"""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepool.functions._col import as_col

# Named references come from the standard library's table; the legacy ones
# are also recognised without a semicolon ("&amp" at the end of a cut title is
# "&"), as HTML parsers read them in text.
NAMED = {n: c for n, c in html5.items() if n.rstrip(";") in name2codepoint or n in ("apos;", "hellip;")}
# ---------------------------------------------------------------------------
# Fixed values:
# A paragraph opens with <p> or <p attr...>; it ends at </p> or at the next
# paragraph start (unclosed <p> are common in real pages).
P_OPEN = r"<p(\s[^>]*)?>"
# ---------------------------------------------------------------------------


def strip_tags(c) -> Column:
    return F.regexp_replace(as_col(c), r"<[^>]*>", "")


def decode_entities(c) -> Column:
    """Named, decimal and hexadecimal references replaced by their
    characters, in one pass ("&amp;lt;" becomes "&lt;"). Texts without "&" are
    only looked at."""
    col = as_col(c)
    pieces = F.split(col, "&", -1)
    table = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])

    def point(code):  # a character from its number, U+FFFD where there is none
        ok = code.isNotNull() & (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        return F.when(ok, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd")

    def one(piece):
        ref = F.regexp_extract(piece, r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);?", 0)
        rest = F.substr(piece, F.length(ref) + 1)
        digits = F.regexp_extract(ref, "([0-9a-fA-F]+);?$", 1)
        number = F.when(ref.rlike("^#[xX]"), F.conv(F.right(digits, F.lit(12)), 16, 10)).otherwise(F.right(digits, F.lit(12))).try_cast("bigint")
        named = F.coalesce(F.element_at(table, ref), F.when(~ref.endswith(";"), F.element_at(table, ref)))
        return (F.when(ref.startswith("#"), F.concat(point(number), rest))
                .when(named.isNotNull(), F.concat(named, rest)).otherwise(F.concat(F.lit("&"), piece)))

    decoded = F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1))), one), ""))
    return F.when(F.instr(col, "&") > 0, decoded).otherwise(col)


def tag_text(c) -> Column:
    """Visible text of an HTML fragment: tags dropped, references decoded."""
    return F.trim(decode_entities(strip_tags(c)))


def inner_html(c, tag: str) -> Column:
    """Inner HTML of the first ``<tag ...>...</tag>`` (empty if none)."""
    return F.regexp_extract(as_col(c), rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1)


def first_tag_text(c, tag: str) -> Column:
    return tag_text(inner_html(c, tag))


def paragraphs(c) -> Column:
    """array<string> of paragraph texts in an HTML fragment, empty ones
    dropped; an unclosed <p> ends where the next one starts."""
    pieces = F.split(as_col(c), P_OPEN)
    body = F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1)))
    texts = F.transform(body, lambda x: tag_text(F.substring_index(x, "</p>", 1)))
    return F.filter(texts, lambda t: t != "")


def hrefs(c) -> Column:
    """array<string> of double-quoted href values, in page order."""
    return F.regexp_extract_all(as_col(c), F.lit(r'href="([^"]+)"'), 1)
