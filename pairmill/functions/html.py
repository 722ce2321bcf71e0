"""Documents to plain text and to HTML, as column expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# What page text is. Markup goes first, then the entities are read, then
# gaps close; each list is applied in order.
MARKUP = [
    r"(?is)<(script|style)\b.*?</(script|style)>",
    r"(?s)<!--.*?-->",
    r"(?s)<[^>]*>",
]
ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
]
GAPS = r"[ \t\r\n]+"


def html_to_text(html: Column) -> Column:
    """Visible text of a page: no scripts, styles, comments or tags; one-space gaps."""
    for pattern in MARKUP:
        html = F.regexp_replace(html, pattern, " ")
    for entity, character in ENTITIES:
        html = F.replace(html, F.lit(entity), F.lit(character))
    return F.trim(F.regexp_replace(html, GAPS, " "))


# A script or style ends at its own closing tag.
BLOCKS = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>"
ENTITY = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
# Named references, as the standard lists them.
NAMED = dict(sorted(name2codepoint.items()))
LAST_CODE_POINT = 0x10FFFF


def _character(code: Column) -> Column:
    """The character of a code point; null where there is none that a text may hold."""
    good = (code > 0) & (code <= LAST_CODE_POINT) & ~code.between(0xD800, 0xDFFF)
    wide = F.unhex(F.lpad(F.hex(F.when(good, code)), 8, "0"))
    return F.decode(wide, "UTF-32")


def decode_entities(text: Column) -> Column:
    """Named and numeric references as characters, in one pass: what they give is not read again.

    An unknown name, or a number without a character, stays as it is.
    """
    names = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])

    def read(entity: Column) -> Column:
        body = F.substring(entity, 2, 40)
        body = F.substring_index(body, ";", 1)
        hexadecimal = F.conv(F.regexp_extract(body, "^#[xX](.*)$", 1), 16, 10)
        decimal = F.regexp_extract(body, "^#([0-9]+)$", 1)
        code = F.coalesce(F.try_element_at(names, body), decimal.try_cast("int"), hexadecimal.try_cast("int"))
        return F.coalesce(_character(code), entity)

    between = F.split(text, ENTITY, -1)
    read_out = F.transform(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)), read)
    # One part more than references: the last meets none.
    return F.array_join(F.zip_with(between, read_out, lambda part, c: F.concat(part, F.coalesce(c, F.lit("")))), "")


def html_to_plain(html: Column) -> Column:
    """`html_to_text` with all references read, and scripts up to their own closing tag."""
    for pattern in (BLOCKS, *MARKUP[1:]):
        html = F.regexp_replace(html, pattern, " ")
    # A no-break space is a gap like others.
    text = F.translate(decode_entities(html), "\u00a0", " ")
    return F.trim(F.regexp_replace(text, GAPS, " "))


def escape(text: Column) -> Column:
    """The three characters HTML text must not hold bare."""
    text = F.replace(text, F.lit("&"), F.lit("&amp;"))
    text = F.replace(text, F.lit("<"), F.lit("&lt;"))
    return F.replace(text, F.lit(">"), F.lit("&gt;"))


def text_to_html(text: Column) -> Column:
    """One paragraph per line of text; empty text gives an empty result."""
    body = F.replace(escape(text), F.lit("\n"), F.lit("</p>\n<p>"))
    page = F.concat(F.lit("<html><body>\n<p>"), body, F.lit("</p>\n</body></html>"))
    return F.when(F.length(text) == 0, "").otherwise(page)
