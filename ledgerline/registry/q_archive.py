"""Sources, payloads and archived pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.text import line_code, line_value
from ledgerline.operators import extract, html, links, lookups, merge
from ledgerline.plans import finance as fin
from ledgerline.registry.book import query
from ledgerline.registry.inputs import DAY, _dotted, _num
from ledgerline.session import new_folder
from ledgerline.sources import archive, payloads, register

DUMPS = {
    "enterprise": "fx_enterprise", "activity": "fx_activity", "address": "fx_address", "branch": "fx_branch",
    "contact": "fx_contact", "establishment": "fx_establishment", "denomination": "fx_denomination", "code": "fx_code",
}


def dump(d, folder, names=DUMPS):
    """Write the register views as CSV dumps with a key/value file."""
    for name in names:
        df = getattr(d, DUMPS[name])
        keep = [c for c, t in df.dtypes if not t.startswith("struct")]
        register.write_raw_csv(df.select(*keep), f"{folder}/{name}.csv")
    latest = d.orders.agg(F.date_format(F.max("o_orderdate"), "dd-MM-yyyy").alias("Value"))
    meta = latest.select(F.lit("SnapshotDate").alias("Variable"), "Value")
    register.write_raw_csv(meta, f"{folder}/{register.META_FILE}")


@query("src01_raw_csv", "SELECT num, enterprise_number, status, juridical_form, type_of_enterprise, start_date FROM fx_enterprise")
def src01(d):
    folder = new_folder(d.spark, "csv")
    dump(d, folder, ["enterprise"])
    back = register.read_raw_csv(d.spark, f"{folder}/enterprise.csv")
    return back.select("num", "enterprise_number", "status", "juridical_form", "type_of_enterprise", "start_date")


@query("src02_bronze_load", " UNION ALL ".join(
    f"SELECT 'kbo_{n}' AS name, count(*) AS written, count(*) AS stored, {str(n != 'code').lower()} AND count(*) > 0 AS split, {str(n != 'code').lower()} AND count(*) > 0 AS sorted FROM {v}"
    for n, v in DUMPS.items()) + " UNION ALL SELECT 'kbo_meta', 1, 1, false, false")
def src02(d):
    """Rows written and stored; whether every file is one bucket of the key, and the rows of a file are in its order."""
    source, target = new_folder(d.spark, "csv"), new_folder(d.spark, "bronze")
    dump(d, source)
    counts = register.load_bronze(d.spark, source, target)
    stored_rows = d.spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(target).select("num", F.input_file_name().alias("file"))
    bucket = F.regexp_extract("file", r"_(\d+)\.c\d+[^/]*$", 1).try_cast("int")
    # The buckets of a table are a power of two, 8 at least, so the class of its key modulo 8 is that of its bucket.
    marked = stored_rows.select(
        F.regexp_extract("file", "/(kbo_[^/]+)/[^/]*$", 1).alias("name"), "file", "num", (F.pmod(F.hash("num"), F.lit(8)) == F.pmod(bucket, F.lit(8))).alias("fits"),
        F.monotonically_increasing_id().alias("at"))
    # rows of one key in one file are counted in buffers of fixed width, so that one row of each is left to the picks, which sort
    keys = marked.groupBy("name", "file", "num").agg(
        F.count("*").alias("stored"), F.bool_and(F.coalesce("fits", F.lit(False))).alias("split"), F.min("at").alias("start"), F.max("at").alias("stop"))
    files = keys.groupBy("name", "file").agg(
        F.sum("stored").alias("stored"), F.bool_and("split").alias("split"),
        (F.min("num").eqNullSafe(F.min_by("num", "start")) & F.max("num").eqNullSafe(F.max_by("num", "stop"))).alias("ends"))
    tables = files.groupBy("name").agg(F.sum("stored").alias("stored"), F.bool_and("split").alias("split"), F.bool_and(F.col("split") & F.col("ends")).alias("sorted"))
    written = d.spark.createDataFrame(list(counts.items()), "name string, written long")
    return written.join(tables, "name", "left").select("name", "written", F.coalesce("stored", F.lit(0)).alias("stored"), *[F.coalesce(c, F.lit(False)).alias(c) for c in ("split", "sorted")])


@query("src03_snapshot_date", "SELECT strftime(max(o_orderdate), '%d-%m-%Y') AS snapshot, count(*) AS orders FROM orders")
def src03(d):
    folder = new_folder(d.spark, "csv")
    dump(d, folder, [])
    return d.orders.agg(F.lit(register.read_snapshot_date(d.spark, folder)).alias("snapshot"), F.count("*").alias("orders"))


@query("src04_provenance", "SELECT num, 'contact.csv' AS source_file, '01-01-2026' AS snapshot_date, true AS stamped FROM fx_contact")
def src04(d):
    p = register.with_provenance(d.fx_contact, "contact.csv", "01-01-2026")
    return p.select("num", F.col("_source_file").alias("source_file"), F.col("_snapshot_date").alias("snapshot_date"), F.col("_ingested_at").isNotNull().alias("stamped"))


@query("src05_bom_csv", "SELECT num, branch_id, branch_name FROM fx_branch")
def src05(d):
    path = new_folder(d.spark, "bom")
    d.fx_branch.withColumnRenamed("num", "\ufeffnum").write.option("header", True).csv(path)
    return register.read_raw_csv(d.spark, path).select("num", "branch_id", "branch_name")


@query("src06_text_lines", """SELECT year, code, val, count(*) AS n FROM (SELECT year, trim(replace(split_part(line, ',', 1), '"', '')) AS code, trim(replace(split_part(line, ',', 2), '"', '')) AS val
FROM (SELECT period_year AS year, unnest(string_split(raw_csv, chr(10))) AS line FROM fx_account WHERE trim(raw_csv) <> '') WHERE line LIKE '%,%') GROUP BY year, code, val""")
def src06(d):
    """Lines of all files under a folder per year; the year is that of each line's path."""
    path = new_folder(d.spark, "lines")
    d.fx_account.where(F.trim("raw_csv") != "").select("raw_csv", "period_year").write.partitionBy("period_year").text(path)
    lines = archive.text_lines(d.spark, path)
    year = F.regexp_extract("path", "/period_year=([0-9]+)/[^/]*$", 1).cast("int")
    parsed = lines.select(year.alias("year"), line_code(F.col("value")).alias("code"), line_value(F.col("value")).alias("val"))
    return parsed.where(F.col("code") != "").groupBy("year", "code", "val").agg(F.count("*").alias("n"))


@query("src06b_filing_files", """WITH a AS (SELECT num, reference, raw_csv FROM fx_account WHERE coalesce(num, '') <> '' AND coalesce(reference, '') <> '' AND coalesce(raw_csv, '') <> ''
AND num IN (SELECT num FROM fx_target WHERE status IS NULL)), l AS (SELECT num, reference, i, string_split(raw_csv, chr(10))[i] AS line FROM a, unnest(range(1, len(string_split(raw_csv, chr(10))) + 1)) AS t(i)),
c AS (SELECT num, reference, i, trim(replace(split_part(line, ',', 1), '"', '')) AS code, trim(replace(split_part(line, ',', 2), '"', '')) AS val FROM l WHERE line LIKE '%,%')
SELECT num, reference, code, arg_max(val, i) AS val FROM c GROUP BY num, reference, code""")
def src06b(d):
    """Filings of some targets written one file each, read back by path, last value of each code in line order."""
    folder = new_folder(d.spark, "filings")
    archive.export_accounts(d.fx_account, folder, d.fx_target.where("status IS NULL"))
    lines = archive.exported_lines(d.spark, folder)
    path = F.regexp_replace("path", "enterprise=([^/]+)/reference=([^/]+)/[^/]*$", "$1/hbb/$2.csv")
    return fin.last_code_values(archive.filing_lines(lines.withColumn("path", path)))


@query("src07_by_keys", "SELECT deposit_id, num, reference FROM fx_account WHERE num IN (SELECT num FROM fx_target WHERE status = 'pending')")
def src07(d):
    return archive.of_keys(d.fx_account, d.fx_target.where("status = 'pending'"), ["deposit_id", "reference"])


@query("src08_fallback", "SELECT deposit_id, num, reference FROM fx_account")
def src08(d):
    nowhere = new_folder(d.spark, "absent")
    primary = lambda: d.spark.read.parquet(nowhere).select("deposit_id", "num", "reference")
    empty = lambda: d.fx_account.where(F.col("reference") == "none").select("deposit_id", "num", "reference")
    return archive.first_filled(primary, empty, lambda: d.fx_account.select("deposit_id", "num", "reference"))


@query("src09_whole_pages", "SELECT page_id, md5(html) AS digest FROM pages")
def src09(d):
    path = new_folder(d.spark, "pages")
    d.pages.select("page_id", F.col("html").alias("value")).write.partitionBy("page_id").option("lineSep", "\x00").text(path)
    back = archive.whole_pages(d.spark, path)
    body = F.regexp_replace("html", "\\x00$", "")
    return back.select(F.regexp_extract("path", "page_id=(\\d+)", 1).cast("long").alias("page_id"), F.md5(body).alias("digest"))


@query("src10_folder_stats", """SELECT count(*) AS files, CAST(sum(size_bytes) AS BIGINT) AS bytes, count(DISTINCT regexp_replace(path, '/[^/]+$', '')) AS folders FROM fx_document""")
def src10(d):
    return archive.stats_of(d.fx_document.select("path", F.col("size_bytes").alias("length")))


@query("src11_deposit_payloads", "SELECT id, num AS enterprise, period_year, reference, migration, 1 AS pages FROM fx_deposit")
def src11(d):
    one = F.struct(
        F.col("id"), F.col("num").alias("enterpriseNumber"), "reference", F.col("period_year").alias("periodEndDateYear"),
        F.col("deposit_date").alias("depositDate"), "language", F.col("model_code").alias("modelCode"), "migration")
    body = F.to_json(F.struct(F.array(one).alias("content"), F.lit(1).alias("totalElements"), F.lit(1).alias("totalPages")))
    rows = payloads.deposit_rows(d.fx_deposit.select(body.alias("body")))
    return rows.select("id", F.col("enterpriseNumber").alias("enterprise"), F.col("periodEndDateYear").alias("period_year"), "reference", "migration", F.col("totalPages").alias("pages"))


def statute_payloads(d):
    totals = d.fx_statute.groupBy("num").agg(F.count("*").alias("n"))
    totals = totals.withColumn("n", F.col("n") + F.when(F.col("num").endswith("7"), 1).otherwise(0))
    one = F.struct(F.col("document_id").alias("documentId"), F.col("deed_date").alias("deedDate"),
                   F.col("document_status").alias("documentStatus"), F.col("document_title").alias("documentTitle"))
    body = F.to_json(F.struct(F.array(one).alias("statutes"), F.col("n").alias("totalItems")))
    return d.fx_statute.join(totals, "num").select("num", body.alias("body"))


@query("src12_statute_payloads", """SELECT num, count(*) AS received, count(*) + CASE WHEN num LIKE '%7' THEN 1 ELSE 0 END AS announced, num NOT LIKE '%7' AS complete
FROM fx_statute GROUP BY num""")
def src12(d):
    return payloads.completeness(payloads.statute_rows(statute_payloads(d)))


@query("src13_page_archive", "SELECT num, page, length(html) AS size FROM fx_card_page")
def src13(d):
    old = archive.archive_pages(d.fx_card_page.withColumn("html", F.lit("old")).where("num like '%1'"))
    merged = merge.replace_rows(old, archive.archive_pages(d.fx_card_page), ["num", "page"])
    return merged.select("num", "page", F.length("html").cast("long").alias("size"))


@query("src14_catalogue", """SELECT 'nbb:' || enterprise || ':' || split_part(path, '/', -1) AS id, enterprise, split_part(path, '/', -1) AS filename, strlen(text) AS size_bytes, sha256(text) AS sha256 FROM fx_document""")
def src14(d):
    files = d.fx_document.select("path", "enterprise", F.col("text").cast("binary").alias("content"))
    return archive.catalogue(files, "nbb").drop("source", "path")


@query("src15_export_counts", """SELECT count(*) FILTER (ok) AS written, count(*) FILTER (NOT ok) AS skipped FROM (
SELECT coalesce(num, '') <> '' AND coalesce(reference, '') <> '' AND coalesce(raw_csv, '') <> '' AS ok FROM fx_account)""")
def src15(d):
    return archive.export_counts(d.fx_account)


@query("src15b_export_targets", """SELECT num, reference, md5(raw_csv || chr(10)) AS digest FROM fx_account WHERE coalesce(num, '') <> '' AND coalesce(reference, '') <> ''
AND coalesce(raw_csv, '') <> '' AND num IN (SELECT num FROM fx_target WHERE status IS NULL)""")
def src15b(d):
    """The stored filings of some targets as one file each, with their texts as they were."""
    folder = new_folder(d.spark, "export")
    archive.export_accounts(d.fx_account, folder, d.fx_target.where("status IS NULL"))
    return archive.exported_texts(d.spark, folder).select("num", "reference", F.md5("value").alias("digest"))


@query("src16_overwrite", "SELECT status, count(*) AS n FROM fx_enterprise GROUP BY status")
def src16(d):
    path = new_folder(d.spark, "table")
    for _ in range(2):
        d.fx_enterprise.write.mode("overwrite").parquet(path)
    return d.spark.read.parquet(path).groupBy("status").agg(F.count("*").alias("n"))


# --- pages ---------------------------------------------------------------------

SEG, C = "c_mktsegment", "c_custkey"
REL = f"{_dotted('c_nationkey')} || ' (ACME ' || c_mktsegment || ')'"
CARD_LABELS = f"""SELECT {_num(C)} AS num, u.label, u.val FROM (SELECT *, [
{{label: 'Numéro d''entreprise', val: {_dotted(C)}}}, {{label: 'Statut', val: CASE WHEN c_custkey % 10 = 0 THEN 'Arrêté' ELSE 'Actif' END}},
{{label: 'Dénomination', val: CASE WHEN c_custkey % 5 = 0 THEN 'Pas de données' ELSE c_name END}},
{{label: 'Dénomination de la personne morale', val: c_name || ' SA'}},
{{label: 'Adresse', val: 'Rue ' || CAST(c_nationkey AS STRING) || ', bte ' || CAST(c_custkey % 90 AS STRING)}},
{{label: 'Capital', val: CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) || ' EUR'}},
{{label: 'Nombre d''unités d''établissement (UE)', val: CAST(c_custkey % 12 AS STRING) || ' UE liste'}},
{{label: 'Administrateur', val: {_dotted('c_nationkey * 3')} || ' Depuis le 1 mai 2020'}}, {{label: 'Gérant', val: 'Dupont , ' || c_mktsegment}},
{{label: 'Depuis le 3 mai', val: 'x'}}, {{label: CASE WHEN c_custkey % 3 = 0 THEN '' ELSE {REL} END, val: 'est absorbé'}}] AS us FROM customer), unnest(us) AS t(u) WHERE u.label <> ''"""


def card_items(d):
    """Rows and links of all cards: parsed once in a session, then read from the landed table."""
    return d.derived("card_items", lambda: html.page_items(d.fx_card_page))


def card_rows(d):
    return html.rows_of(card_items(d))


@query("htm01_label_values", CARD_LABELS)
def htm01(d):
    return extract.label_values(card_rows(d))


@query("win12_longest_value", f"SELECT num, count(*) AS labels, max(val) FILTER (label = 'Adresse') AS adresse, max(val) FILTER (label = 'Capital') AS capital FROM ({CARD_LABELS}) GROUP BY num")
def win12(d):
    kv = extract.label_values(card_rows(d))
    return kv.groupBy("num").agg(
        F.count("*").alias("labels"), F.max(F.when(F.col("label") == "Adresse", F.col("val"))).alias("adresse"),
        F.max(F.when(F.col("label") == "Capital", F.col("val"))).alias("capital"))


def card_pages(d):
    """Keys of the cards, which have labels, and of the raw web pages, which have none.

    Each table's keys are made distinct before the union: Spark 4.1 takes a union of scans bucketed alike for bucketed, but
    one that is read in column batches only puts their buckets one after the other.
    """
    return d.fx_card_page.select("num").distinct().unionByName(d.fx_web_page.select("num").distinct())


def all_items(d):
    return card_items(d).unionByName(d.derived("web_items", lambda: html.page_items(d.fx_web_page)))


@query("htm02_card_fields", f"""SELECT {_num(C)} AS num, {_dotted(C)} AS numero, CASE WHEN c_custkey % 10 = 0 THEN 'Arrêté' ELSE 'Actif' END AS statut,
CASE WHEN c_custkey % 5 = 0 THEN c_name || ' SA' ELSE c_name END AS denomination, 'Rue ' || CAST(c_nationkey AS STRING) || ', bte ' || CAST(c_custkey % 90 AS STRING) AS adresse_siege,
CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) || ' EUR' AS capital, CAST(c_custkey % 12 AS INT) AS nb_etablissements, NULL::VARCHAR AS email FROM customer
UNION ALL SELECT 'w' || CAST(page_id AS STRING), NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM pages""")
def htm02(d):
    f = extract.grouped(extract.card_fields(extract.label_values(html.rows_of(all_items(d))), card_pages(d)))
    return f.select(
        "num", "generalites.numero", "generalites.statut", "generalites.denomination", "generalites.adresse_siege", "donnees_financieres.capital",
        "nb_etablissements", "contact.email")


def sections(d):
    return extract.with_section(card_rows(d))


FUN = "CASE WHEN c_custkey % 2 = 0 THEN 'Fonctions' ELSE 'Functies' END"


@query("htm03_sections", f"""SELECT {_num(C)} AS num, CAST(r.k AS INT) AS row_no, r.s AS section FROM (SELECT *, list_concat(list_transform(range(1, 9), lambda i: {{k: i, s: 'Généralités'}}),
list_transform(range(10, 14), lambda i: {{k: i, s: {FUN}}}), [{{k: 15, s: 'Liens entre entités'}}, {{k: 17, s: 'Activités'}}]) AS rs FROM customer), unnest(rs) AS t(r)""")
def htm03(d):
    return sections(d).select("num", "row_no", "section")


@query("htm04_officers", f"""SELECT {_num(C)} AS num, 10 AS row_no, 'Administrateur' AS fonction, {_dotted('c_nationkey * 3')} AS nom, 'Depuis le 1 mai 2020' AS depuis FROM customer
UNION ALL SELECT {_num(C)}, 11, 'Gérant', 'Dupont , ' || c_mktsegment, NULL FROM customer""")
def htm04(d):
    return extract.officers(sections(d))


@query("htm05_relations", f"""SELECT {_num(C)} AS num, 15 AS row_no, {_num('c_nationkey')} AS bce, 'ACME ' || c_mktsegment AS nom, {REL} || ' est absorbé' AS texte FROM customer WHERE c_custkey % 3 <> 0""")
def htm05(d):
    return extract.relations(sections(d))


@query("htm06_activity_links", f"""SELECT {_num(C)} AS num, '2008' AS nace_version, CAST(70000 + c_custkey % 900 AS STRING) AS nace_code, CAST(70000 + c_custkey % 900 AS STRING) || ' Activité ' || c_mktsegment AS ligne FROM customer""")
def htm06(d):
    return extract.activity_links(html.links_of(card_items(d))).drop("link_no")


@query("htm07_outbound_links", f"""SELECT {_num(C)} AS num, 'ejustice' AS kind, 'http://a.example/ejustice/' || CAST(c_custkey AS STRING) AS href FROM customer
UNION ALL SELECT {_num(C)}, 'nbb', 'http://consult.cbso.nbb.be/' || CAST(c_custkey AS STRING) FROM customer
UNION ALL SELECT {_num(C)}, 'notaire', 'http://statuts.notaire.be/' || CAST(c_custkey AS STRING) FROM customer WHERE c_custkey % 6 = 0""")
def htm07(d):
    return extract.outbound_links(links.link_targets(d.fx_card_page))


@query("htm10_establishment_link", f"SELECT {_num(C)} AS num, 'toonvestigingps.html?ondernemingsnummer=' || CAST(c_custkey AS STRING) AS ue_url FROM customer")
def htm10(d):
    return extract.establishment_link(links.link_targets(d.fx_card_page))


PUBS = f"""SELECT {_num('o_custkey')} AS num, 'P' || CAST(o_orderkey AS STRING) AS numac, {DAY} AS date, 'Acte ' || o_orderpriority || ' no ' || CAST(o_orderkey AS STRING) || ' image' AS titre,
'https://www.ejustice.just.fgov.be/tsv_pdf/' || replace({DAY}, '-', '/') || '/P' || CAST(o_orderkey AS STRING) || '.pdf' AS pdf_url, o_orderkey AS page, 0 AS link_no FROM orders
UNION ALL SELECT {_num('o_custkey')}, 'N' || CAST(o_orderkey % 5 AS STRING), '2020-01-02', 'Avis du ' || arg_max({DAY}, o_orderkey) || ' avis',
'https://pub.example/tsv_pdf/2020/01/02/N' || CAST(o_orderkey % 5 AS STRING) || '.pdf', min(o_orderkey), 2 FROM orders GROUP BY o_custkey, o_orderkey % 5"""


def publication_items(d):
    return html.links_of(d.derived("publication_items", lambda: html.page_items(d.fx_pub_page)))


@query("htm08_publications", f"SELECT num, numac, date, titre, pdf_url FROM ({PUBS})")
def htm08(d):
    return extract.publications(publication_items(d)).drop("place")


@query("win10_dedup_publications", f"SELECT num, numac, titre, page, CAST(link_no AS INT) AS link_no FROM ({PUBS})")
def win10(d):
    p = extract.publications(publication_items(d))
    return p.select("num", "numac", "titre", "place.page", "place.link_no")


@query("htm09_last_page", """SELECT 'p' || CAST(page_id AS STRING) AS id, coalesce(list_max(list_transform(regexp_extract_all(url || html, '[?&]page=(\\d+)', 1), lambda x: TRY_CAST(x AS INT))), 1) AS last FROM pages
UNION ALL SELECT num || '/' || CAST(page AS STRING), coalesce(list_max(list_transform(regexp_extract_all(html, '[?&]page=(\\d+)', 1), lambda x: TRY_CAST(x AS INT))), 1) FROM fx_pub_page""")
def htm09(d):
    a = d.pages.select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"), extract.last_page(F.concat("url", "html")).alias("last"))
    b = d.fx_pub_page.select(F.concat_ws("/", "num", F.col("page").cast("string")).alias("id"), extract.last_page(F.col("html")).alias("last"))
    return a.unionByName(b)


@query("htm11_keyword_rows", f"""SELECT {_num(C)} AS num, 10 AS row_no, 'Administrateur ' || {_dotted('c_nationkey * 3')} || ' Depuis le 1 mai 2020' AS row_text FROM customer
UNION ALL SELECT {_num(C)}, 11, 'Gérant Dupont , ' || c_mktsegment FROM customer UNION ALL SELECT {_num(C)}, 12, 'Depuis le 3 mai x' FROM customer""")
def htm11(d):
    return extract.rows_with(card_rows(d), ["Gérant", "Depuis le", "Sinds"]).select("num", "row_no", "row_text")


LINKS_RE = """'(?i)<a\\s[^>]*?href="([^"]*)"'"""


@query("htm12_page_links", f"SELECT page_id, CAST(length(html) AS INT) AS size, CAST(len(regexp_extract_all(html, {LINKS_RE}, 1)) AS INT) AS links FROM pages")
def htm12(d):
    return extract.page_numbers(d.pages)


@query("htm12b_keyword_links", f"""SELECT DISTINCT page_id, href FROM (SELECT page_id, unnest(regexp_extract_all(html, {LINKS_RE}, 1)) AS href FROM pages)
WHERE contains(lower(href), 'th') OR contains(lower(href), 'pdf')""")
def htm12b(d):
    return extract.links_with(d.pages, ["th", "pdf"])


@query("htm13_dated_lines", """WITH t AS (SELECT 'd' || CAST(doc_id AS STRING) AS id, text FROM documents UNION ALL SELECT 'a' || CAST(deposit_id AS STRING), raw_csv FROM fx_account),
l AS (SELECT id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM t)
SELECT id, CAST(line_no AS INT) AS line_no, trim(line) AS line FROM l WHERE regexp_matches(line, '\\d{2}[-/]\\d{2}[-/]\\d{4}|\\d{4}-\\d{2}-\\d{2}')""")
def htm13(d):
    a = d.documents.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text")
    b = d.fx_account.select(F.concat(F.lit("a"), F.col("deposit_id").cast("string")).alias("id"), F.col("raw_csv").alias("text"))
    return extract.dated_lines(a.unionByName(b), "id")


@query("htm14_page_record", f"""SELECT {_num(C)} AS num, '/kbopub/' || {_num(C)} || '.html' AS archive, 2 AS fonctions, CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 1 END AS liens, 1 AS activites,
CAST(c_custkey % 12 AS INT) AS nb_etablissements, {_dotted(C)} AS numero, 'toonvestigingps.html?ondernemingsnummer=' || CAST(c_custkey AS STRING) AS ue_url,
'http://a.example/ejustice/' || CAST(c_custkey AS STRING) AS ejustice, CASE WHEN c_custkey % 6 = 0 THEN 'http://statuts.notaire.be/' || CAST(c_custkey AS STRING) END AS notaire FROM customer
UNION ALL SELECT 'w' || CAST(page_id AS STRING), '/kbopub/w' || CAST(page_id AS STRING) || '.html', 0, 0, 0, NULL, NULL, NULL, NULL, NULL FROM pages""")
def htm14(d):
    items = all_items(d)
    record = extract.card_records(card_pages(d), html.rows_of(items), html.links_of(items)).counts()
    merged = merge.replace_rows(record.where("num like '%5'"), record, ["num"])
    return merged.select(
        "num", "archive", "fonctions", F.col("liens_entites").alias("liens"), "activites", "nb_etablissements", "generalites.numero", "ue_url",
        "liens_externes.ejustice", "liens_externes.notaire")


@query("htm14b_publication_record", f"""WITH p AS ({PUBS}), n AS (SELECT num, count(*) AS n FROM p GROUP BY num), k AS (SELECT {_num('o_custkey')} AS num, count(*) AS pages FROM orders GROUP BY 1)
SELECT p.num, k.pages, n.n AS nb_publications, p.numac, p.date FROM p JOIN n ON n.num = p.num JOIN k ON k.num = p.num""")
def htm14b(d):
    record = extract.publication_records(d.fx_pub_page, extract.publications(publication_items(d)))
    return record.rows("publications", "pages", "nb_publications").select("num", "pages", "nb_publications", "numac", "date")


@query("jn12_officer_names", f"""WITH n AS (SELECT num, coalesce(arg_min(valeur, pos) FILTER (type_code = '001'), arg_min(valeur, pos)) AS name FROM fx_denomination WHERE coalesce(valeur, '') <> '' GROUP BY num)
SELECT {_num(C)} AS num, 10 AS row_no, coalesce(n.name, {_dotted('c_nationkey * 3')}) AS nom, {_num('c_nationkey * 3')} AS ref_bce, true AS is_company FROM customer LEFT JOIN n ON n.num = {_num('c_nationkey * 3')}
UNION ALL SELECT {_num(C)}, 11, 'Dupont , ' || c_mktsegment, NULL, false FROM customer""")
def jn12(d):
    resolved = lookups.resolve_officers(extract.officers(sections(d)), d.fx_denomination)
    return resolved.select("num", "row_no", "nom", "ref_bce", "is_company")
