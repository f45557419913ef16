"""Targets of the links of archived pages with built-in functions only, for what needs neither rows nor surrounding text."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Comments, scripts and styles hold no links; of a link tag the value of its first href counts, in any of three quotings.
_ATTRIBUTES = r"""(?:"[^"]*"|'[^']*'|[^'">])*"""
LINK = rf"(?is)<!--.*?-->|<(script|style)\b{_ATTRIBUTES}>.*?</\1\s*>|<a(?=[\s/>]){_ATTRIBUTES}>"
HREF = r"""(?is)^<a(?:\s+(?!href[\s=/>])[^\s=>]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?)*\s+href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]*))"""
_ENTITY = r"&#[0-9]+;|&#[xX][0-9a-fA-F]+;|&[a-zA-Z][a-zA-Z0-9]*;|[^&]+|&"


def unescaped(text: Column) -> Column:
    """Character references, by name or number, as characters; unknown ones stay. Texts without ``&`` are left alone."""
    names = F.str_to_map(F.lit("\x01".join(f"{k[:-1]}\x02{v}" for k, v in html5.items() if k.endswith(";"))), F.lit("\x01"), F.lit("\x02"))

    def one(piece: Column) -> Column:
        code = F.when(piece.rlike("^&#[0-9]"), F.regexp_extract(piece, "([0-9]+)", 1).try_cast("long")).when(
            piece.rlike("^&#[xX]"), F.conv(F.regexp_extract(piece, "^&#[xX]([0-9a-fA-F]+)", 1), 16, 10).try_cast("long"))
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        number = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        name = F.when(piece.rlike("^&[a-zA-Z]"), F.try_element_at(names, F.regexp_extract(piece, "^&([a-zA-Z0-9]+);", 1)))
        return F.coalesce(F.when(piece.startswith("&#"), number).otherwise(name), piece)

    pieces = F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0))
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, one), "")).otherwise(text)


def link_targets(pages: DataFrame) -> DataFrame:
    """``(num, page, link_no, href)`` of every link with a target, numbered in page order."""
    tags = F.filter(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(0)), lambda t: t.rlike(HREF))
    href = lambda t: unescaped(F.concat(*[F.regexp_extract(t, HREF, i) for i in (1, 2, 3)]))
    return pages.select("num", F.col("page").cast("long").alias("page"), F.posexplode(F.transform(tags, href)).alias("link_no", "href"))
