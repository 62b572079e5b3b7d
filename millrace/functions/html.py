"""Text and links out of raw HTML, as columns."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from millrace.functions import markup

# Named character entities that are written out, the ampersand last.
ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", " "), ("&mdash;", "\u2014"), ("&ndash;", "\u2013"),
    ("&hellip;", "\u2026"), ("&lsquo;", "\u2018"), ("&rsquo;", "\u2019"), ("&ldquo;", "\u201c"), ("&rdquo;", "\u201d"),
    ("&laquo;", "\u00ab"), ("&raquo;", "\u00bb"), ("&middot;", "\u00b7"), ("&bull;", "\u2022"), ("&copy;", "\u00a9"), ("&reg;", "\u00ae"),
    ("&trade;", "\u2122"), ("&euro;", "\u20ac"), ("&pound;", "\u00a3"), ("&deg;", "\u00b0"), ("&times;", "\u00d7"), ("&amp;", "&"),
]
_NUMBER = "(?s)^#(?:([0-9]{1,7})|[xX]([0-9a-fA-F]{1,6}));(.*)$"


def _character(piece: Column) -> Column:
    """What follows an ampersand, with the character in front if it is a numbered one."""
    decimal, digits = F.regexp_extract(piece, _NUMBER, 1), F.regexp_extract(piece, _NUMBER, 2)
    code = F.coalesce(F.when(decimal != "", F.conv(decimal, 10, 16)), F.when(digits != "", digits))
    number = F.conv(code, 16, 10).cast("int")
    sound = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.when(sound, code), 8, "0")), "UTF-32")
    return F.coalesce(F.concat(char, F.regexp_extract(piece, _NUMBER, 3)), F.concat(F.lit("&"), piece))


def unescaped(text: Column) -> Column:
    """Entities as characters: numbered ones, and the named ones of the list."""
    pieces = F.split(text, "&")
    numbered = F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(F.slice(pieces, 2, F.size(pieces)), _character), ""))
    text = F.when(text.contains("&#"), numbered).otherwise(text)
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def sql_unescaped(text: str) -> str:
    """SQL that writes out the named entities, for checks."""
    for entity, char in ENTITIES:
        text = f"replace({text}, '{entity}', '{char.replace(chr(39), 2 * chr(39))}')"
    return text


def tag_texts(html: Column, tags: list[str]) -> Column:
    """The texts of the outermost elements of these names, in page order; see ``markup.element_texts``."""
    @F.arrow_udf(T.ArrayType(T.StringType()))
    def texts(pages: pa.Array) -> pa.Array:
        return pa.array([None if p is None else markup.element_texts(p, tags) for p in pages.to_pylist()], pa.list_(pa.string()))
    return texts(html)


def tags_text(html: Column, tags: list[str]) -> Column:
    return F.array_join(tag_texts(html, tags), " ")


@F.arrow_udf(T.ArrayType(T.StringType()))
def targets(pages: pa.Array) -> pa.Array:
    """What the anchors of each page point to, as written but for entities."""
    return pa.array([None if p is None else markup.targets(p) for p in pages.to_pylist()], pa.list_(pa.string()))


def site_of(url: Column) -> Column:
    return F.regexp_extract(url, "^(https?://[^/?#]+)", 1)


def links(html: Column, site: Column) -> Column:
    """Every anchor target as an absolute address, in order, repeats included.

    ``https://`` addresses stay; what starts with ``/`` is put behind the site; anything else goes
    behind the site and a slash. Anchors without a target are left out. Pages are read as a browser reads them: anchors in
    comments and scripts are none, and entities in targets are written out.
    """
    base = F.regexp_replace(site, "/$", "")
    return F.transform(
        targets(html),
        lambda h: F.when(h.startswith("https://"), h).when(h.startswith("/"), F.concat(base, h))
        .otherwise(F.concat(base, F.lit("/"), h)),
    )
