"""Web card and publication fields from page rows and links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.constants import (
    CARD_FIELDS, CARD_GROUPS, DATE_LINE_PATTERN, LINK_CLASSES, NO_DATA, NO_DATA_PHRASES, OFFICER_SECTIONS, PAGE_PATTERN,
    PUBLICATION_HOST, PUBLICATION_PATTERN, RELATION_SECTIONS,
)
from ledgerline.functions.keys import clean_number
from ledgerline.functions.text import absolute_url, first_integer, label, none_if_empty
from ledgerline.operators.nest import Record, record
from ledgerline.operators.picks import dedup_publications


def label_values(rows: DataFrame) -> DataFrame:
    """Label and value: cells of class QL with the next cell, and first cell with the rest of the row.

    Per label the longest non-empty value stays, the first one on ties; this is an aggregate
    that combines map-side.
    """
    data = F.filter("cells", lambda c: c["tag"] == "td")
    tds = rows.select("num", "page", "row_no", data.alias("tds"))
    next_td = F.transform(
        "tds",
        lambda c, i: F.struct(c["text"].alias("label"), F.get(F.col("tds"), i + 1)["text"].alias("val"), c["cls"].alias("cls"), i.alias("at")),
    )
    marked = F.filter(next_td, lambda p: F.array_contains(F.split(p["cls"], r"\s+"), "QL"))
    rest = F.array_join(F.transform(F.slice("tds", F.lit(2), F.size("tds")), lambda c: c["text"]), " ")
    whole = F.when(
        F.size("tds") >= 2,
        F.array(F.struct(F.get("tds", F.lit(0))["text"].alias("label"), rest.alias("val"), F.lit("").alias("cls"), F.lit(0).alias("at"))),
    ).otherwise(F.filter(next_td, lambda p: F.lit(False)))
    pairs = tds.select("num", "row_no", F.explode(F.concat(
        F.transform(marked, lambda p: F.struct(F.lit(0).alias("pass"), p.alias("p"))),
        F.transform(whole, lambda p: F.struct(F.lit(1).alias("pass"), p.alias("p"))),
    )).alias("x"))
    pairs = pairs.select(
        "num", label(F.col("x.p.label")).alias("label"), F.trim("x.p.val").alias("val"),
        F.struct(-F.col("x.pass"), -F.col("row_no"), -F.col("x.p.at")).alias("early"),
    ).where((F.col("label") != "") & (F.coalesce("val", F.lit("")) != ""))
    return pairs.groupBy("num", "label").agg(F.max_by("val", F.struct(F.length("val"), "early")).alias("val"))


def card_fields(labels: DataFrame, pages: DataFrame) -> DataFrame:
    """Labelled fields of each card of the page table; "no data" counts as missing, synonyms in order.

    A page without usable labels is a card with empty fields.
    """
    wanted = sorted({name for names in CARD_FIELDS.values() for name in names})
    usable = labels.where(F.col("label").isin(wanted) & ~F.col("val").contains(NO_DATA))
    by_label = usable.groupBy("num").agg(*[F.max(F.when(F.col("label") == n, F.col("val"))).alias(f"l{i}") for i, n in enumerate(wanted)])
    place = {n: f"l{i}" for i, n in enumerate(wanted)}
    fields = {f: F.coalesce(*[F.col(place[n]) for n in names]) for f, names in CARD_FIELDS.items()}
    out = by_label.select("num", *[c.alias(f) for f, c in fields.items()])
    out = out.withColumn("nb_etablissements", first_integer(F.col("etablissements"))).drop("etablissements")
    return pages.select("num").distinct().join(out, "num", "left")


def grouped(fields: DataFrame) -> DataFrame:
    """The fields of a card as one struct per group."""
    groups = [F.struct(*names).alias(g) for g, names in CARD_GROUPS.items()]
    return fields.select("num", *groups, "nb_etablissements")


def card_records(pages: DataFrame, rows: DataFrame, links: DataFrame) -> Record:
    """Web card records: groups, outbound links, list of establishments and archive path per card; officers, relations and
    activities as children. ``rows`` and ``links`` are those of ``pages``."""
    out = outbound_links(links).groupBy("num").pivot("kind", [name for _, name in LINK_CLASSES]).agg(F.first("href"))
    out = out.select("num", F.struct(*[name for _, name in LINK_CLASSES]).alias("liens_externes"))
    base = grouped(card_fields(label_values(rows), pages)).join(out, "num", "left").join(establishment_link(links), "num", "left")
    base = base.withColumn("archive", F.concat(F.lit("/kbopub/"), "num", F.lit(".html")))
    titled = with_section(rows)
    return record(base, {
        "fonctions": (officers(titled).withColumn("pos", F.col("row_no")), ["fonction", "nom", "depuis"]),
        "liens_entites": (relations(titled).withColumn("pos", F.col("row_no")), ["bce", "nom", "texte"]),
        "activites": (activity_links(links).withColumn("pos", F.col("link_no")), ["nace_version", "nace_code", "ligne"]),
    })


def publication_records(pages: DataFrame, found: DataFrame) -> Record:
    """Publication records: number of publications and of pages read per enterprise; the publications as children."""
    read = pages.groupBy("num").agg(F.countDistinct("page").alias("pages"))
    counted = found.groupBy("num").agg(F.count("*").alias("nb_publications"))
    base = read.join(counted, "num", "left").fillna(0, ["nb_publications"])
    return record(base, {"publications": (found.withColumn("pos", F.col("place")), ["numac", "date", "titre", "pdf_url"])})


def with_section(rows: DataFrame) -> DataFrame:
    """Each row with the title of the header row (first cell of class I) it stands under.

    The window covers the rows of one page only.
    """
    first = F.get("cells", F.lit(0))
    header = F.array_contains(F.split(first["cls"], r"\s+"), "I")
    w = Window.partitionBy("num", "page").orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    titled = rows.withColumn("is_header", header)
    titled = titled.withColumn("section", F.last(F.when(F.col("is_header"), first["text"]), ignorenulls=True).over(w))
    return titled.where(~F.col("is_header")).drop("is_header")


def _cell(i: int) -> Column:
    return F.get("cells", F.lit(i))["text"]


def officers(rows: DataFrame) -> DataFrame:
    """Function, name and since of the officer section's rows."""
    listed = rows.where(F.col("section").isin(OFFICER_SECTIONS) & (F.size("cells") >= 2))
    out = listed.select("num", "row_no", _cell(0).alias("fonction"), _cell(1).alias("nom"), _cell(2).alias("depuis"))
    return out.where(
        (F.col("fonction") != "") & (F.col("nom") != "") & ~F.col("nom").startswith("Depuis") & ~F.col("fonction").contains("Depuis")
    )


def relations(rows: DataFrame) -> DataFrame:
    """Linked entities: number and name found in the row's text."""
    listed = rows.where(F.col("section").isin(RELATION_SECTIONS))
    text = F.trim(F.array_join(F.transform("cells", lambda c: c["text"]), " "))
    out = listed.select("num", "row_no", text.alias("texte"))
    missing = reduce(lambda a, b: a | b, [F.col("texte").contains(p) for p in NO_DATA_PHRASES])
    number = none_if_empty(F.regexp_extract("texte", r"(\d{4}\.\d{3}\.\d{3})", 1))
    name = none_if_empty(F.trim(F.regexp_extract("texte", r"\(([^)]+)\)", 1)))
    return out.where((F.col("texte") != "") & ~missing).select(
        "num", "row_no", clean_number(number).alias("bce"), name.alias("nom"), "texte"
    )


def activity_links(links: DataFrame) -> DataFrame:
    """Version and code of activity links; the code falls back to the link's text."""
    kept = links.where(F.col("href").contains("naceToelichting"))
    return kept.select(
        "num", "link_no", none_if_empty(F.regexp_extract("href", r"nace\.version=(\d+)", 1)).alias("nace_version"),
        F.coalesce(none_if_empty(F.regexp_extract("href", r"nace\.code=(\d+)", 1)), "text").alias("nace_code"),
        F.col("row_text").alias("ligne"),
    )


def link_class(href: Column) -> Column:
    out = F.lit(None).cast("string")
    for mark, name in reversed(LINK_CLASSES):
        out = F.when(href.contains(mark), name).otherwise(out)
    return out


def outbound_links(links: DataFrame) -> DataFrame:
    """Last outbound link of each class."""
    classed = links.withColumn("kind", link_class(F.col("href"))).where(F.col("kind").isNotNull())
    return classed.groupBy("num", "kind").agg(F.max_by("href", F.struct("page", "link_no")).alias("href"))


def establishment_link(links: DataFrame) -> DataFrame:
    """First link to the list of establishments."""
    kept = links.where(F.col("href").contains("toonvestigingps"))
    return kept.groupBy("num").agg(F.min_by("href", F.struct("page", "link_no")).alias("ue_url"))


def publication_links(links: DataFrame) -> DataFrame:
    """Dated publication links of each page, before any de-duplication."""
    found = links.where(F.regexp_extract("href", PUBLICATION_PATTERN, 4) != "")
    part = [F.regexp_extract("href", PUBLICATION_PATTERN, i) for i in range(1, 5)]
    return found.select(
        "num", "page", "link_no", part[3].alias("numac"), F.concat_ws("-", *part[:3]).alias("date"),
        none_if_empty(F.col("block_text")).alias("titre"), absolute_url(F.col("href"), PUBLICATION_HOST).alias("pdf_url"),
    )


def publications(links: DataFrame) -> DataFrame:
    return dedup_publications(publication_links(links))


def last_page(html: Column) -> Column:
    """Highest page number linked from a page, 1 without any."""
    found = F.regexp_extract_all(html, F.lit(PAGE_PATTERN), 1)
    return F.coalesce(F.array_max(F.transform(found, lambda p: p.try_cast("int"))), F.lit(1))


def rows_with(rows: DataFrame, words: list[str]) -> DataFrame:
    """Table rows whose text has one of the words."""
    text = F.array_join(F.transform("cells", lambda c: c["text"]), " ")
    hit = reduce(lambda a, b: a | b, [F.col("row_text").contains(w) for w in words])
    return rows.withColumn("row_text", text).where(hit)


def hrefs(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'(?i)<a\s[^>]*?href="([^"]*)"'), 1)


def page_numbers(pages: DataFrame) -> DataFrame:
    """Size and number of links per page."""
    return pages.select("page_id", F.length("html").alias("size"), F.size(hrefs(F.col("html"))).alias("links"))


def links_with(pages: DataFrame, words: list[str]) -> DataFrame:
    """Distinct links of each page with one of the words."""
    links = pages.select("page_id", F.explode(F.array_distinct(hrefs(F.col("html")))).alias("href"))
    hit = reduce(lambda a, b: a | b, [F.lower("href").contains(w) for w in words])
    return links.where(hit)


def dated_lines(texts: DataFrame, key: str) -> DataFrame:
    """Text lines with a date and their line number."""
    lines = texts.select(key, F.posexplode(F.split("text", "\n")).alias("line_no", "line")).withColumn("line", F.trim("line"))
    return lines.where(F.col("line").rlike(DATE_LINE_PATTERN))
