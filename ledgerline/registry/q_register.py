"""Register queries: scalar functions, filters, picks, joins, counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.constants import FORMS_WITHOUT_DEEDS, PUBLIC_FORMS, SEAT_TYPES, SECTOR_CODES, SECTOR_LABELS
from ledgerline.functions import dates, keys, text
from ledgerline.operators import filters, lookups, nest, paging, picks, rollups, search
from ledgerline.plans import entities
from ledgerline.plans import finance as fin
from ledgerline.registry.book import query
from ledgerline.registry.inputs import view
from ledgerline.registry.sqltext import FILINGS
from ledgerline.session import new_folder


def inlist(values):
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# --- strings -------------------------------------------------------------------


@query("str01_clean_number", "SELECT num, trim(replace(replace(enterprise_number, '.', ''), ' ', '')) AS cleaned FROM fx_enterprise")
def str01(d):
    return d.fx_enterprise.select("num", keys.clean_number(F.col("enterprise_number")).alias("cleaned"))


@query("str02_company_number", """SELECT num, pos, CASE length(x) WHEN 9 THEN '0' || x WHEN 10 THEN x END AS bce
FROM (SELECT num, pos, regexp_replace(valeur, '\\D', '', 'g') AS x FROM fx_denomination)
UNION ALL SELECT c_name, -1, CASE length(x) WHEN 9 THEN '0' || x WHEN 10 THEN x END FROM (SELECT c_name, regexp_replace(c_name, '\\D', '', 'g') AS x FROM customer)""")
def str02(d):
    a = d.fx_denomination.select("num", "pos", keys.company_number(F.col("valeur")).alias("bce"))
    b = d.customer.select(F.col("c_name").alias("num"), F.lit(-1).alias("pos"), keys.company_number(F.col("c_name")).alias("bce"))
    return a.unionByName(b)


@query("str05_line_parse", """SELECT deposit_id, trim(replace(split_part(line, ',', 1), '"', '')) AS code, trim(replace(split_part(line, ',', 2), '"', '')) AS val
FROM (SELECT deposit_id, unnest(string_split(raw_csv, chr(10))) AS line FROM fx_account) WHERE line LIKE '%,%'""")
def str05(d):
    lines = d.fx_account.select("deposit_id", F.explode(F.split("raw_csv", "\n")).alias("line"))
    parsed = lines.select("deposit_id", text.line_code(F.col("line")).alias("code"), text.line_value(F.col("line")).alias("val"))
    return parsed.where(F.col("code") != "")


@query("str06_path_keys", """SELECT path, CASE WHEN path LIKE '/%/hbb/%' THEN split_part(path, '/', 2) ELSE '' END AS enterprise,
CASE WHEN path LIKE '/%/hbb/%.csv' THEN replace(split_part(path, '/', 4), '.csv', '') ELSE '' END AS reference FROM fx_document""")
def str06(d):
    p = F.col("path")
    return d.fx_document.select("path", text.path_enterprise(p).alias("enterprise"), text.path_reference(p).alias("reference"))


@query("str08_filing_year", """SELECT id, CASE WHEN regexp_full_match(split_part(coalesce(reference, ''), '-', 1), '[0-9]{4}') THEN split_part(reference, '-', 1)
WHEN deposit_date IS NOT NULL THEN substr(deposit_date, 1, 4) ELSE CAST(period_year AS STRING) END AS annee FROM fx_deposit""")
def str08(d):
    y = dates.filing_year(F.col("reference"), F.col("deposit_date"), F.col("period_year"))
    return d.fx_deposit.select("id", y.alias("annee"))


ISO_SQL = "coalesce(strftime(try_strptime(start_date, '%d-%m-%Y'), '%Y-%m-%d'), start_date)"


@query("str09_iso_date", f"SELECT num, start_date, {ISO_SQL} AS iso FROM fx_enterprise")
def str09(d):
    return d.fx_enterprise.select("num", "start_date", dates.iso_date(F.col("start_date")).alias("iso"))


@query("str10_iso_from_date", f"""SELECT 'o' || CAST(o_orderkey AS STRING) AS id, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders
UNION ALL SELECT num, {ISO_SQL.replace("start_date", f"({ISO_SQL})")} FROM fx_enterprise""")
def str10(d):
    o, e = d.orders, d.fx_enterprise
    kind = dict(o.dtypes)["o_orderdate"]
    a = o.select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"), dates.iso_from(F.col("o_orderdate"), kind).alias("iso"))
    once = dates.iso_from(F.col("start_date"), "string")
    return a.unionByName(e.select(F.col("num").alias("id"), dates.iso_from(once, "string").alias("iso")))


@query("str11_names_and_years", """SELECT document_id, coalesce(substr(deed_date, 1, 4), 'unknown') AS annee,
num || '_' || coalesce(replace(deed_date, '-', ''), 'unknown') || '_' || CAST(document_id AS STRING) || '.pdf' AS filename FROM fx_statute""")
def str11(d):
    day = F.coalesce(F.replace("deed_date", F.lit("-"), F.lit("")), F.lit("unknown"))
    name = F.concat_ws("_", "num", day, F.concat(F.col("document_id").cast("string"), F.lit(".pdf")))
    return d.fx_statute.select("document_id", dates.deed_year(F.col("deed_date")).alias("annee"), name.alias("filename"))


@query("str12_squeeze", """SELECT doc_id, md5(trim(regexp_replace(text, '[ \\t\\n\\r\\f\\v]+', ' ', 'g'))) AS squeezed,
rtrim(trim(regexp_replace(source || ' : :', '[ \\t\\n\\r\\f\\v]+', ' ', 'g')), ':') AS raw_label FROM documents""")
def str12(d):
    lab = F.regexp_replace(text.squeeze(F.concat("source", F.lit(" : :"))), ":+$", "")
    return d.documents.select("doc_id", F.md5(text.squeeze(F.col("text"))).alias("squeezed"), lab.alias("raw_label"))


@query("str13_postal_line", """SELECT num, pos, nullif(concat_ws(', ', nullif(concat_ws(' ', nullif(street_fr, ''), nullif(house_number, '')), ''),
nullif(concat_ws(' ', nullif(zipcode, ''), nullif(municipality_fr, '')), '')), '') AS adresse FROM fx_address""")
def str13(d):
    a = text.postal_line(*map(F.col, ("street_fr", "house_number", "zipcode", "municipality_fr")))
    return d.fx_address.select("num", "pos", a.alias("adresse"))


@query("str14_bilingual_address", """SELECT num, pos, trim(coalesce(nullif(street_fr, ''), street_nl, '') || ' ' || coalesce(house_number, '') || ', ' || coalesce(zipcode, '')
|| ' ' || coalesce(nullif(municipality_fr, ''), municipality_nl, ''), ', ') AS adresse FROM fx_address""")
def str14(d):
    fr = F.coalesce(text.none_if_empty(F.col("street_fr")), "street_nl")
    town = F.coalesce(text.none_if_empty(F.col("municipality_fr")), "municipality_nl")
    return d.fx_address.select("num", "pos", text.bilingual_line(fr, F.col("house_number"), F.col("zipcode"), town).alias("adresse"))


@query("str15_display_name", """SELECT num, coalesce(arg_min(valeur, pos) FILTER (type_code = '001'), arg_min(valeur, pos)) AS denomination
FROM fx_denomination WHERE coalesce(valeur, '') <> '' GROUP BY num""")
def str15(d):
    return picks.display_names(d.fx_denomination)


@query("str16_media_type", """SELECT filename, CASE lower(CASE WHEN contains(filename, '.') THEN split_part(filename, '.', -1) ELSE '' END)
WHEN 'pdf' THEN 'application/pdf' WHEN 'csv' THEN 'text/csv' WHEN 'html' THEN 'text/html' ELSE 'application/octet-stream' END AS media FROM fx_document""")
def str16(d):
    return d.fx_document.select("filename", text.media_type(F.col("filename")).alias("media"))


@query("str17_clip", "SELECT doc_id, nullif(substr(text, 1, 200), '') AS titre, (SELECT count(*) FROM fx_target WHERE length(error) > 90) AS n FROM documents")
def str17(d):
    n = d.fx_target.where(F.length("error") > 90).agg(F.count("*")).scalar()
    return d.documents.select("doc_id", text.clip(F.col("text"), 200).alias("titre")).withColumn("n", n)


@query("str18_sha_and_size", "SELECT doc_id, sha256(text) AS sha256, strlen(text) AS size_bytes FROM documents")
def str18(d):
    return d.documents.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), F.octet_length("text").cast("long").alias("size_bytes"))


@query("str19_absolute_url", """SELECT page_id, CASE WHEN href LIKE 'http%' THEN href ELSE 'https://host.example' || href END AS url FROM (
SELECT page_id, unnest([url, '/' || split_part(url, '/', 4)]) AS href FROM pages)""")
def str19(d):
    p = d.pages.select("page_id", F.explode(F.array(F.col("url"), F.concat(F.lit("/"), F.split_part("url", F.lit("/"), F.lit(4))))).alias("href"))
    return p.select("page_id", text.absolute_url(F.col("href"), "https://host.example").alias("url"))


@query("str20_query_url", """SELECT document_id, 'https://host.example/api/' || num || '?deedDate=' || coalesce(deed_date, '') || '&title=' || replace(url_encode(document_title), '%20', '+')
AS url FROM fx_statute""")
def str20(d):
    base = F.concat(F.lit("https://host.example/api/"), "num")
    url = text.query_url(base, deedDate=F.coalesce("deed_date", F.lit("")), title=F.col("document_title"))
    return d.fx_statute.select("document_id", url.alias("url"))


@query("str21_display_formats", """SELECT o_orderkey, format('{:,}', CAST(round_even(o_totalprice, 0) AS BIGINT)) AS milliers,
CAST(CAST(CAST(o_totalprice / 1000 AS DECIMAL(18,2)) AS DECIMAL(18,1)) AS STRING) || '%' AS pct,
CASE WHEN abs(o_totalprice * 10) >= 1e6 THEN printf('%.1f', o_totalprice * 10 / 1e6) || 'M €' ELSE format('{:,}', CAST(round_even(o_totalprice * 10, 0) AS BIGINT)) || ' €' END AS euros
FROM orders""")
def str21(d):
    v = F.col("o_totalprice")
    return d.orders.select(
        "o_orderkey", text.thousands(v).alias("milliers"), text.percent_text(F.round(v / 1000, 2)).alias("pct"), text.euro_text(v * 10).alias("euros")
    )


@query("str22_base64", "SELECT document_id, body, octet_length(encode(body)) AS bytes FROM fx_statute")
def str22(d):
    packed = d.fx_statute.select("document_id", F.base64(F.col("body").cast("binary")).alias("b64"))
    raw = packed.select("document_id", F.unbase64("b64").alias("raw"))
    return raw.select("document_id", F.col("raw").cast("string").alias("body"), F.length("raw").cast("long").alias("bytes"))


@query("str23_first_integer", """SELECT 'd' || CAST(doc_id AS STRING) AS id, TRY_CAST(nullif(regexp_extract(text, '[0-9]+'), '') AS INTEGER) AS n FROM documents WHERE regexp_extract(text, '[0-9]+') <> ''
UNION ALL SELECT path, TRY_CAST(regexp_extract(path, '[0-9]+') AS INTEGER) FROM fx_document""")
def str23(d):
    a = d.documents.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), text.first_integer(F.col("text")).alias("n"),
                           F.regexp_extract("text", r"\d+", 0).alias("found")).where(F.col("found") != "").drop("found")
    return a.unionByName(d.fx_document.select(F.col("path").alias("id"), text.first_integer(F.col("path")).alias("n")))


@query("str24_event_payload", """SELECT doc_id, '{"enterprise":"' || enterprise || '","title":"' || coalesce(title, filename) || '","path":"' || path || '"}' AS payload FROM fx_document""")
def str24(d):
    payload = F.to_json(F.struct("enterprise", F.coalesce("title", "filename").alias("title"), "path"))
    return d.fx_document.select("doc_id", payload.alias("payload"))


# --- filters -------------------------------------------------------------------


@query("flt01_active", "SELECT replace(enterprise_number, '.', '') AS num FROM fx_enterprise WHERE status = 'AC'")
def flt01(d):
    return filters.active_numbers(d.fx_enterprise)


@query("flt01b_active_limit", "SELECT replace(enterprise_number, '.', '') AS num FROM fx_enterprise WHERE status = 'AC' ORDER BY 1 LIMIT 25")
def flt01b(d):
    return filters.active_numbers(d.fx_enterprise, limit=25)


@query("flt03_form_not_public", f"SELECT num FROM fx_enterprise WHERE juridical_form IS NULL OR juridical_form NOT IN ({inlist(PUBLIC_FORMS)})")
def flt03(d):
    return d.fx_enterprise.where(filters.not_in(F.col("juridical_form"), PUBLIC_FORMS)).select("num")


MAIN_SQL = f"SELECT DISTINCT num FROM fx_activity WHERE classification = 'MAIN' AND nace_code IN ({inlist(SECTOR_CODES)})"


@query("flt04_main_activity", MAIN_SQL)
def flt04(d):
    return filters.main_activity_of(d.fx_activity, SECTOR_CODES)


@query("flt04b_main_activity_nested", f"SELECT num FROM fx_enterprise WHERE num IN ({MAIN_SQL})")
def flt04b(d):
    rec = nest.record(d.fx_enterprise, {"activites": (d.fx_activity, ["nace_code", "classification"])})
    return rec.base.select("num").join(filters.main_activity_of(rec.children["activites"], SECTOR_CODES), "num", "left_semi")


SECTOR_SQL = f"""SELECT num, juridical_form FROM fx_enterprise WHERE status = 'AC' AND type_of_enterprise = '2'
AND (juridical_form IS NULL OR juridical_form NOT IN ({inlist(PUBLIC_FORMS)})) AND num IN ({MAIN_SQL})"""


@query("flt05_sector", SECTOR_SQL)
def flt05(d):
    return filters.sector_enterprises(d.fx_enterprise, d.fx_activity).select("num", "juridical_form")


@query("flt06_seats", """SELECT e.num, CAST(count(a.num) AS INT) AS sieges, min(a.street_nl) AS rue FROM fx_enterprise e
LEFT JOIN fx_address a ON a.num = e.num AND a.type_of_address IN ('Siège', 'REGO') GROUP BY e.num""")
def flt06(d):
    seats = d.fx_address.where(F.col("type_of_address").isin(SEAT_TYPES))
    first = seats.groupBy("num").agg(F.count("*").cast("int").alias("sieges"), F.min_by("street_nl", "pos").alias("rue"))
    return rollups.zero_filled(d.fx_enterprise.select("num"), first, "num", "sieges")


@query("flt07_any_path", """SELECT num FROM fx_enterprise e WHERE EXISTS (SELECT 1 FROM fx_activity a WHERE a.num = e.num AND a.nace_code IN ('55100', '55203'))
OR EXISTS (SELECT 1 FROM fx_denomination n WHERE n.num = e.num AND n.type_code = '003') ORDER BY num LIMIT 1""")
def flt07(d):
    a = d.fx_activity.where(F.col("nace_code").isin("55100", "55203")).select("num")
    b = d.fx_denomination.where("type_code = '003'").select("num")
    return d.fx_enterprise.join(a.unionByName(b).distinct(), "num", "left_semi").select("num").orderBy("num").limit(1)


@query("flt08_guarded_update", f"""SELECT e.num, CASE WHEN s.num IS NOT NULL THEN {ISO_SQL} END AS start_iso, s.num IS NOT NULL AS has_rich
FROM fx_enterprise e LEFT JOIN fx_branch s ON e.num = s.num""")
def flt08(d):
    rich = d.fx_enterprise.join(d.fx_branch, "num").select("num", F.struct("start_date", "branch_id").alias("rich"))
    base = d.fx_enterprise.select("num").join(rich, "num", "left")
    fixed = F.when(F.col("rich").isNotNull(), F.col("rich").withField("start_date", dates.iso_date(F.col("rich.start_date")))).otherwise(F.col("rich"))
    out = base.withColumn("rich", fixed)
    return out.select("num", F.col("rich.start_date").alias("start_iso"), F.col("rich").isNotNull().alias("has_rich"))


@query("flt09_number_prefix", "SELECT num FROM fx_enterprise WHERE starts_with(num, '00000001')")
def flt09(d):
    return d.fx_enterprise.where(filters.number_prefix(F.col("num"), "0000.000 1")).select("num")


@query("flt10_name_contains", "SELECT DISTINCT num FROM fx_denomination WHERE contains(lower(valeur), lower('MER#00000000'))")
def flt10(d):
    table = d.derived("name_grams", lambda: search.gram_table(d.fx_denomination, "num", "valeur"), "word")
    counts = d.derived("name_gram_counts", lambda: search.gram_counts(table), "word")
    return search.containing(table, counts, d.fx_denomination, "num", "valeur", "MER#00000000")


@query("flt11_any_token", "SELECT doc_id FROM documents WHERE list_has_any(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+'), ['that', 'queque'])")
def flt11(d):
    table = d.derived("document_tokens", lambda: search.token_table(d.documents, "doc_id", "text"), "word")
    return search.keys_with_any(table, "doc_id", "That queque")


@query("flt12_fiscal_year", """SELECT id, 'min' AS mode FROM fx_deposit WHERE period_year >= 1999 UNION ALL SELECT id, 'set' FROM fx_deposit
WHERE CASE WHEN regexp_full_match(split_part(coalesce(reference, ''), '-', 1), '[0-9]{4}') THEN split_part(reference, '-', 1)
WHEN deposit_date IS NOT NULL THEN substr(deposit_date, 1, 4) ELSE CAST(period_year AS STRING) END IN ('1996', '1998')""")
def flt12(d):
    dep = d.fx_deposit
    a = filters.fiscal_year_kept(dep, min_year=1999).select("id", F.lit("min").alias("mode"))
    return a.unionByName(filters.fiscal_year_kept(dep, years=["1996", "1998"]).select("id", F.lit("set").alias("mode")))


@query("flt14_statute_done", "SELECT document_id FROM fx_statute WHERE document_status = 'DONE'")
def flt14(d):
    return filters.all_equal(d.fx_statute, document_status="DONE").select("document_id")


@query("flt15_deeds_expected", f"""SELECT num FROM fx_enterprise WHERE status = 'AC' AND (juridical_form IS NULL OR juridical_form NOT IN ({inlist(FORMS_WITHOUT_DEEDS)}))""")
def flt15(d):
    status = F.when(F.col("status") == "AC", "Active").otherwise("Stopped")
    return d.fx_enterprise.where(filters.deeds_expected(F.col("juridical_form"), status)).select("num")


@query("flt16_content_valid", """SELECT doc_id, starts_with(text, 'The') AS marked, strlen(text) > 1000 AS large, doc_id % 3 = 0 OR strlen(text) >= 1000 AS statute FROM documents""")
def flt16(d):
    raw = F.when(F.col("text").startswith("The"), F.concat(F.lit("%PDF"), "text")).otherwise(F.col("text")).cast("binary")
    return d.documents.select("doc_id", filters.is_pdf(raw).alias("marked"), filters.is_large(F.col("text").cast("binary")).alias("large"),
        filters.is_statute(F.when(F.col("doc_id") % 3 == 0, "application/pdf;v=1").when(F.col("doc_id") % 3 == 1, "text/html"), F.col("text").cast("binary")).alias("statute"))


@query("flt17_path_allowed", r"""SELECT path, starts_with(path, '/') AND NOT contains(path, '..') AND (starts_with(path, '/documents/') OR starts_with(path, '/kbopub/')
OR starts_with(path, '/ejustice/') OR regexp_full_match(path, '/[0-9]+/hbb/[^/]+\.csv')) AS allowed FROM fx_document""")
def flt17(d):
    return d.fx_document.select("path", text.path_allowed(F.col("path")).alias("allowed"))


@query("flt18_shard", "SELECT num FROM fx_enterprise WHERE CAST(num AS BIGINT) % 8 = 3")
def flt18(d):
    return d.fx_enterprise.where(keys.in_shard(F.col("num"), 8, 3)).select("num")


@query("flt20_optional_terms", "SELECT doc_id FROM fx_document WHERE source = 'notaire' AND enterprise = '0000000001' UNION ALL SELECT -doc_id FROM fx_document WHERE source = 'nbb'")
def flt20(d):
    a = filters.all_equal(d.fx_document, source="notaire", enterprise="0000000001").select("doc_id")
    return a.unionByName(filters.all_equal(d.fx_document, source="nbb", enterprise=None).select((-F.col("doc_id")).alias("doc_id")))


# --- picks ---------------------------------------------------------------------


@query("win04_deposit_per_year", """SELECT num, period_year, id, reference, language FROM fx_deposit WHERE NOT starts_with(coalesce(model_code, ''), 'mc')
QUALIFY row_number() OVER (PARTITION BY num, period_year ORDER BY coalesce(language, '') = 'FR' DESC,
CASE WHEN language = 'FR' THEN pos END DESC, pos) = 1""")
def win04(d):
    return picks.deposits_by_year(d.fx_deposit).drop("migration")


@query("win15_latest_usable", """SELECT num, period_year, id FROM (SELECT * FROM fx_deposit WHERE NOT starts_with(coalesce(model_code, ''), 'mc')
QUALIFY row_number() OVER (PARTITION BY num, period_year ORDER BY coalesce(language, '') = 'FR' DESC, CASE WHEN language = 'FR' THEN pos END DESC, pos) = 1)
WHERE NOT coalesce(migration, false) QUALIFY row_number() OVER (PARTITION BY num ORDER BY period_year DESC) = 1""")
def win15(d):
    return picks.latest_usable_deposit(d.fx_deposit).select("num", "period_year", "id")


@query("win06_official_name", "SELECT num, valeur AS nom_officiel FROM fx_denomination WHERE type_code = '001' QUALIFY row_number() OVER (PARTITION BY num ORDER BY language, pos) = 1")
def win06(d):
    return picks.official_names(d.fx_denomination)


@query("win07_seat_address", """SELECT num, type_of_address, street_nl, zipcode FROM fx_address
QUALIFY row_number() OVER (PARTITION BY num ORDER BY type_of_address = 'REGO' DESC, pos) = 1""")
def win07(d):
    return picks.seat_addresses(d.fx_address).select("num", "type_of_address", "street_nl", "zipcode")


NAMES_SQL = """(SELECT k.num, CASE WHEN a.num IS NOT NULL THEN a.valeur ELSE o.valeur END AS nom FROM (SELECT DISTINCT num FROM fx_denomination) k
LEFT JOIN (SELECT num, valeur FROM fx_denomination WHERE type_code = '001' AND language = '1') a ON a.num = k.num
LEFT JOIN (SELECT num, valeur FROM fx_denomination WHERE type_code = '001' QUALIFY row_number() OVER (PARTITION BY num ORDER BY language, pos) = 1) o ON o.num = k.num)"""


@query("win08_name_in_language", f"SELECT num, nom FROM {NAMES_SQL}")
def win08(d):
    return picks.names_in_language(d.fx_denomination, "FR").select("num", "nom")


DEDUP_SQL = """(SELECT * FROM fx_activity QUALIFY row_number() OVER (PARTITION BY num, coalesce(nace_code, ''), coalesce(classification, '') ORDER BY pos) = 1)"""


@query("win09_dedup_activities", f"SELECT num, nace_code, classification, nace_version, activity_group FROM {DEDUP_SQL}")
def win09(d):
    return picks.dedup_activities(d.fx_activity).drop("pos")


# --- reshape -------------------------------------------------------------------


@query("prj01_array_projection", "SELECT num, nace_code, classification FROM fx_activity WHERE num IN (SELECT num FROM fx_enterprise)")
def prj01(d):
    rec = nest.record(d.fx_enterprise, {"activites": (d.fx_activity, ["nace_code", "classification", "activity_group"])})
    return rec.rows("activites").select("num", "nace_code", "classification")


@query("prj02_rename_key", "SELECT replace(enterprise_number, '.', '') AS id, status FROM fx_enterprise")
def prj02(d):
    e = d.fx_enterprise.withColumn("_num", keys.clean_number(F.col("enterprise_number")))
    return e.drop("num", "enterprise_number").withColumnRenamed("_num", "id").select("id", "status")


@query("prj03_nested_overwrite", f"SELECT num, {ISO_SQL} AS start_iso, status FROM fx_enterprise")
def prj03(d):
    e = d.fx_enterprise.select("num", F.struct("start_date", "status").alias("rich"))
    e = e.withColumn("rich", F.col("rich").withField("start_date", dates.iso_date(F.col("rich.start_date"))))
    return e.select("num", F.col("rich.start_date").alias("start_iso"), F.col("rich.status").alias("status"))


ACT_ORDER = "-coalesce(TRY_CAST(nace_version AS INT), 0), coalesce(classification, '~'), pos"


def activity_order():
    """Newest version first, then class, then input order; the position is unique, so no range holds more than its share."""
    return -F.coalesce(F.col("nace_version").try_cast("int"), F.lit(0)), F.coalesce("classification", F.lit("~")), F.col("pos")


@query("srt06_activity_order", f"SELECT num, nace_version, classification, nace_code FROM fx_activity ORDER BY num, {ACT_ORDER}")
def srt06(d):
    # read once and in another order than that of the landed table, so the view is sorted as it comes
    return view(d.spark, d.sf, "fx_activity").orderBy("num", *activity_order()).select("num", "nace_version", "classification", "nace_code")


@query("prj05_comparison_table", f"""SELECT e.num, n.nom, e.status, e.start_date, a.nace_code AS code_nace, coalesce(b.n, 0) AS nb_etablissements FROM fx_enterprise e
LEFT JOIN {NAMES_SQL} n ON n.num = e.num LEFT JOIN fx_activity a ON a.num = e.num
LEFT JOIN (SELECT num, count(*) AS n FROM fx_establishment GROUP BY num) b ON b.num = e.num""")
def prj05(d):
    counts = d.fx_establishment.groupBy("num").agg(F.count("*").alias("nb_etablissements"))
    base = rollups.zero_filled(d.fx_enterprise.join(picks.names_in_language(d.fx_denomination), "num", "left"), counts, "num", "nb_etablissements")
    rec = nest.record(base, {"activites": (d.fx_activity.withColumnRenamed("nace_code", "code_nace"), ["code_nace"])})
    return rec.rows("activites", "nom", "status", "start_date", "nb_etablissements", every=True).drop("pos")


@query("prj06_transpose", """WITH t AS (SELECT status, count(*) AS enterprises, count(juridical_form) AS with_form, count(start_date) AS with_date FROM fx_enterprise GROUP BY status)
SELECT k AS key, max(v) FILTER (status = 'AC') AS "AC", max(v) FILTER (status = 'ST') AS "ST" FROM (
SELECT status, 'enterprises' AS k, enterprises AS v FROM t UNION ALL SELECT status, 'with_form', with_form FROM t UNION ALL SELECT status, 'with_date', with_date FROM t) GROUP BY k""")
def prj06(d):
    wide = d.fx_enterprise.groupBy("status").agg(
        F.count("*").alias("enterprises"), F.count("juridical_form").alias("with_form"), F.count("start_date").alias("with_date"))
    return wide.transpose("status")


@query("prj07_explode_recollect", "SELECT num, pos, lower(coalesce(valeur, '?')) AS valeur FROM fx_denomination WHERE num IN (SELECT num FROM fx_enterprise)")
def prj07(d):
    rec = nest.record(d.fx_enterprise, {"names": (d.fx_denomination, ["valeur"])})
    return rec.rows("names").select("num", "pos", F.lower(F.coalesce("valeur", F.lit("?"))).alias("valeur"))


# --- joins ---------------------------------------------------------------------


@query("jn02_one_to_one", """SELECT e.num, b.branch_name FROM fx_enterprise e LEFT JOIN (SELECT num, min(branch_name) AS branch_name FROM fx_branch GROUP BY num) b
ON b.num = replace(e.enterprise_number, '.', '')""")
def jn02(d):
    one = picks.first_per_key(d.fx_branch, ["num"], "branch_name").select("num", "branch_name")
    e = d.fx_enterprise.select(keys.clean_number(F.col("enterprise_number")).alias("num"))
    return e.join(one, "num", "left")


@query("jn03_one_to_many", "SELECT e.num, e.status, x.path FROM fx_enterprise e LEFT JOIN fx_document x ON x.enterprise = e.num")
def jn03(d):
    docs = d.fx_document.select(F.col("enterprise").alias("num"), "path", F.col("path").alias("pos"))
    return nest.record(d.fx_enterprise, {"documents": (docs, ["path"])}).rows("documents", "status", every=True).drop("pos")


@query("jn04_concat_sources", """SELECT e.num, x.src, x.id, x.k FROM fx_enterprise e LEFT JOIN (
SELECT num, 0 AS src, deposit_id AS id, 'a' || CAST(deposit_id AS STRING) AS k FROM fx_account UNION ALL
SELECT num, 1, document_id, 's' || CAST(document_id AS STRING) FROM fx_statute) x ON x.num = e.num""")
def jn04(d):
    def tagged(df, src, key, mark):
        return df.select("num", F.struct(F.lit(src).alias("src"), F.col(key).alias("id")).alias("pos"), F.concat(F.lit(mark), F.col(key).cast("string")).alias("k"))

    both = tagged(d.fx_account, 0, "deposit_id", "a").unionByName(tagged(d.fx_statute, 1, "document_id", "s"))
    return nest.record(d.fx_enterprise, {"items": (both, ["k"])}).rows("items", every=True).select("num", "pos.src", "pos.id", "k")


def rich(d, done=None):
    return entities.rich(d.fx_enterprise, d.fx_activity, d.fx_address, d.fx_branch, d.fx_contact, d.fx_establishment, d.fx_denomination, d.fx_code, done)


CHILD_COUNTS = " ".join(
    f"LEFT JOIN (SELECT num, count(*) AS n FROM {t} GROUP BY num) {a} ON {a}.num = e.num"
    for t, a in [("fx_activity", "c1"), ("fx_address", "c2"), ("fx_branch", "c3"), ("fx_contact", "c4"), ("fx_establishment", "c5"), ("fx_denomination", "c6")]
)
COUNT_COLS = ", ".join(
    f"CAST(coalesce(c{i}.n, 0) AS INT) AS {n}" for i, n in enumerate(["activites", "adresses", "succursales", "contacts", "etablissements", "denominations"], 1)
)
CHILDREN = ["activites", "adresses", "succursales", "contacts", "etablissements", "denominations"]


@query("jn05_denormalise", f"SELECT e.num, e.status, {COUNT_COLS} FROM fx_enterprise e {CHILD_COUNTS}")
def jn05(d):
    return rich(d).counts().select("num", "status", *CHILDREN)


LABEL_CTE = """labels AS (SELECT category, code, arg_max(description, pos) FILTER (language = 'FR') AS fr, arg_max(description, pos) FILTER (language = 'NL') AS nl
FROM fx_code GROUP BY category, code)"""
DECODED = """SELECT a.num, a.nace_version, a.nace_code, a.classification, a.activity_group, g.fr AS group_fr, g.nl AS group_nl, c.fr AS classification_fr,
c.nl AS classification_nl, n.fr AS nace_fr, n.nl AS nace_nl FROM {t} a LEFT JOIN labels g ON g.category = 'ActivityGroup' AND g.code = a.activity_group
LEFT JOIN labels c ON c.category = 'Classification' AND c.code = a.classification
LEFT JOIN labels n ON n.category = CASE WHEN coalesce(a.nace_version, '') = '' THEN 'Nace2008' ELSE 'Nace' || a.nace_version END AND n.code = a.nace_code"""


@query("jn06_decode_activities", f"WITH {LABEL_CTE} {DECODED.format(t='fx_activity')}")
def jn06(d):
    return lookups.decode_activities(d.fx_activity, d.fx_code).drop("pos")


@query("jn07_decode_fallback", f"""WITH {LABEL_CTE} SELECT a.num, a.nace_code, a.classification, coalesce(nullif(c.fr, ''), nullif(c.nl, ''), a.classification) AS classe,
coalesce(nullif(n.fr, ''), nullif(n.nl, ''), a.nace_code) AS description, coalesce(nullif(g.fr, ''), nullif(g.nl, ''), a.activity_group) AS groupe
FROM fx_activity a LEFT JOIN labels g ON g.category = 'ActivityGroup' AND g.code = trim(a.activity_group)
LEFT JOIN labels c ON c.category = 'Classification' AND c.code = trim(a.classification)
LEFT JOIN labels n ON n.category = CASE WHEN coalesce(a.nace_version, '') = '' THEN 'Nace2008' ELSE 'Nace' || a.nace_version END AND n.code = trim(a.nace_code)""")
def jn07(d):
    t = entities.translated_activities(d.fx_activity, d.fx_code, "FR")
    return t.select("num", "nace_code", "classification", "classe", "description", "groupe")


@query("jn08_resume", "SELECT num FROM fx_enterprise WHERE num NOT IN (SELECT num FROM fx_branch)")
def jn08(d):
    return d.fx_enterprise.select("num").join(d.fx_branch.select("num").distinct(), "num", "left_anti")


@query("jn09_has_gold", "SELECT num, num IN (SELECT num FROM fx_filing_line) AS has_gold FROM (SELECT num FROM fx_enterprise ORDER BY num LIMIT 200)")
def jn09(d):
    shown = paging.page(d.fx_enterprise.select("num"), limit=200)
    gold_keys = d.fx_filing_line.select("num").join(F.broadcast(shown), "num", "left_semi")
    return lookups.flag_present(shown, gold_keys, "has_gold")


@query("jn11_key_set", """SELECT deposit_id, num FROM fx_account WHERE num IN (SELECT num FROM fx_denomination
WHERE contains(valeur, '00'))""")
def jn11(d):
    hits = d.fx_denomination.where(F.contains("valeur", F.lit("00"))).select("num")
    return d.fx_account.select("deposit_id", "num").join(hits, "num", "left_semi")


DOC_LIST = """SELECT enterprise, 'publication' AS type, source, year, filename, path, coalesce(nullif(title, ''), nullif(reference, ''), filename) AS label FROM fx_document
UNION ALL SELECT num, 'comptes_annuels_csv', 'nbb', CAST(period_year AS STRING), reference || '.csv', '/' || num || '/hbb/' || reference || '.csv', reference
FROM fx_account WHERE coalesce(reference, '') <> '' AND num IS NOT NULL AND '/' || num || '/hbb/' || reference || '.csv' NOT IN (SELECT path FROM fx_document)"""


@query("jn14_document_list", DOC_LIST)
def jn14(d):
    return lookups.document_list(d.fx_document.withColumn("type", F.lit("publication")), d.fx_account)


@query("srt03_document_order", DOC_LIST + " ORDER BY coalesce(source, ''), coalesce(year, ''), path")
def srt03(d):
    return paging.by_source_and_year(jn14(d))


# --- counts --------------------------------------------------------------------

FX_COUNTED = ["fx_enterprise", "fx_denomination", "fx_address", "fx_activity", "fx_contact", "fx_establishment", "fx_branch", "fx_code"]


@query("agg01_table_counts", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows FROM {t}" for t in FX_COUNTED))
def agg01(d):
    return rollups.table_counts({t: getattr(d, t) for t in FX_COUNTED})


@query("agg02_dashboard", f"""WITH {FILINGS} SELECT (SELECT count(*) FROM fx_enterprise) AS entreprises, (SELECT count(*) FROM fx_target) AS cibles,
(SELECT count(*) FROM fx_target WHERE status = 'done') AS cibles_done, (SELECT count(*) FROM fx_document WHERE source = 'notaire') AS statuts_notaire,
(SELECT count(*) FROM fx_account) AS comptes_csv, (SELECT count(DISTINCT num) FROM growth) AS hotels_gold""")
def agg02(d):
    parts = {"entreprises": d.fx_enterprise, "cibles": d.fx_target, "cibles_done": d.fx_target.where("status = 'done'"),
             "statuts_notaire": d.fx_document.where("source = 'notaire'"), "comptes_csv": d.fx_account,
             "hotels_gold": fin.filing_amounts(fin.usable_lines(d.fx_filing_line)).select("num").distinct()}
    return rollups.one_row(rollups.table_counts(parts), list(parts))


@query("agg03_source_counts", """SELECT count(*) AS documents, count(*) FILTER (source = 'nbb') AS nbb, count(*) FILTER (source = 'notaire') AS notaire,
count(*) FILTER (source = 'ejustice') AS ejustice FROM fx_document""")
def agg03(d):
    by = [F.count_if(F.col("source") == s).alias(s) for s in ("nbb", "notaire", "ejustice")]
    return d.fx_document.agg(F.count("*").alias("documents"), *by)


@query("agg04_status_breakdown", """SELECT count(*) AS total, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'done') AS done,
count(*) FILTER (status = 'error') AS error, round(coalesce(100.0 * count(*) FILTER (status IN ('done', 'error')) / nullif(count(*), 0), 0), 1) AS pct FROM fx_target""")
def agg04(d):
    return rollups.status_breakdown(d.fx_target)


@query("agg05_filings_sum", "SELECT CAST(coalesce(sum(filings_count), 0) AS BIGINT) AS filings FROM fx_target WHERE status = 'done'")
def agg05(d):
    return d.fx_target.where("status = 'done'").agg(F.coalesce(F.sum("filings_count"), F.lit(0)).alias("filings"))


@query("agg06_done_without_filing", "SELECT count(*) AS targets FROM fx_target WHERE status = 'done' AND filings_count = 0")
def agg06(d):
    return d.fx_target.agg(F.count_if((F.col("status") == "done") & (F.col("filings_count") == 0)).alias("targets"))


@query("agg07_documents_per_enterprise", "SELECT enterprise, count(*) AS documents FROM fx_document GROUP BY enterprise")
def agg07(d):
    return d.fx_document.groupBy("enterprise").agg(F.count("*").alias("documents"))


LABEL_ROWS = ", ".join("('" + k + "', '" + v.replace("'", "''") + "')" for k, v in SECTOR_LABELS.items())


@query("agg08_sector_breakdown", f"""SELECT v.nace_code, v.label, count(DISTINCT a.num) AS enterprises FROM (VALUES {LABEL_ROWS}) AS v(nace_code, label)
LEFT JOIN fx_activity a ON trim(a.nace_code) = v.nace_code AND trim(a.classification) = 'MAIN' GROUP BY v.nace_code, v.label""")
def agg08(d):
    codes = d.fx_activity.where(F.trim("classification") == "MAIN").select("num", F.trim("nace_code").alias("nace_code"))
    return rollups.sector_breakdown(d.spark, codes.where(F.col("nace_code").isin(SECTOR_CODES)))


@query("agg09_status_tally", """SELECT v.status, count(t.num) AS targets FROM (VALUES ('pending'), ('done'), ('error')) AS v(status)
LEFT JOIN fx_target t ON t.status = v.status GROUP BY v.status""")
def agg09(d):
    return rollups.status_tally(d.spark, d.fx_target)


@query("agg11_distinct_capped", "SELECT DISTINCT nace_code FROM fx_activity")
def agg11(d):
    return d.fx_activity.select("nace_code").distinct()


@query("agg12_version_map", """SELECT num, nace_version, coalesce(classification, '?') || ':' || nace_code AS activite, count(*) AS n
FROM fx_activity GROUP BY ALL""")
def agg12(d):
    shown = F.concat(F.coalesce("classification", F.lit("?")), F.lit(":"), "nace_code")
    return d.fx_activity.groupBy("num", "nace_version", shown.alias("activite")).agg(F.count("*").alias("n"))


@query("agg13_contact_lists", """SELECT num, CASE contact_type WHEN 'TEL' THEN 'telephone' WHEN 'EMAIL' THEN 'email' ELSE 'site_web' END AS kind, value, min(pos) AS pos, count(*) AS n
FROM fx_contact WHERE contact_type IN ('TEL', 'EMAIL', 'WEB') GROUP BY ALL""")
def agg13(d):
    kind = F.col("contact_type")
    named = F.when(kind == "TEL", "telephone").when(kind == "EMAIL", "email").when(kind == "WEB", "site_web")
    rows = d.fx_contact.withColumn("kind", named).where("kind IS NOT NULL")
    return rows.groupBy("num", "kind", "value").agg(F.min("pos").alias("pos"), F.count("*").alias("n"))


@query("agg14_code_dictionary", f"WITH {LABEL_CTE} SELECT category, code, fr, nl FROM labels")
def agg14(d):
    return lookups.code_labels(d.fx_code).select("category", "code", F.col("FR").alias("fr"), F.col("NL").alias("nl"))


@query("agg15_dictionary_size", "SELECT category, count(DISTINCT code) AS entries FROM fx_code GROUP BY category")
def agg15(d):
    return d.fx_code.groupBy("category").agg(F.countDistinct("code").alias("entries"))


@query("agg19_run_summary", """WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS rank, CASE c_custkey % 5 WHEN 0 THEN 'skipped' WHEN 1 THEN 'errors' ELSE 'processed' END AS outcome FROM customer)
SELECT CAST((rank - 1) // 1000 + 1 AS BIGINT) AS lot, count(*) AS seen, count(*) FILTER (outcome = 'processed') AS processed, count(*) FILTER (outcome = 'skipped') AS skipped,
count(*) FILTER (outcome = 'errors') AS errors FROM r GROUP BY 1""")
def agg19(d):
    k = F.col("c_custkey") % 5
    outcome = F.when(k == 0, "skipped").when(k == 1, "errors").otherwise("processed")
    return rollups.run_summary(d.customer.select(F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("num"), outcome.alias("outcome")), 1000)


@query("agg20_array_sizes", "SELECT e.num, CAST(count(b.num) AS INT) AS nb_etablissements FROM fx_enterprise e LEFT JOIN fx_establishment b ON b.num = e.num GROUP BY e.num")
def agg20(d):
    b = d.fx_establishment.withColumn("pos", F.col("establishment_number"))
    return nest.record(d.fx_enterprise, {"nb_etablissements": (b, ["establishment_number"])}).counts().select("num", "nb_etablissements")


@query("agg21_sum_of_squares", "SELECT count(*) AS n, CAST(sum(o_orderkey * o_orderkey) AS BIGINT) AS carres FROM orders")
def agg21(d):
    return rollups.sum_of_squares(d.orders, "o_orderkey").select("n", F.col("total").alias("carres"))


@query("agg22_ingest_result", """SELECT num, count(*) AS deposits, count(*) FILTER (period_year >= 1996) AS filings, count(*) FILTER (period_year >= 1996 AND id % 3 <> 0) AS pdf,
count(*) FILTER (period_year >= 1996 AND NOT coalesce(migration, false)) AS csv FROM fx_deposit GROUP BY num""")
def agg22(d):
    kept = F.col("period_year") >= 1996
    return d.fx_deposit.groupBy("num").agg(
        F.count("*").alias("deposits"), F.count_if(kept).alias("filings"), F.count_if(kept & (F.col("id") % 3 != 0)).alias("pdf"),
        F.count_if(kept & ~F.coalesce(F.col("migration"), F.lit(False))).alias("csv"))


@query("agg23_modified_rows", f"SELECT count(*) AS total, count(*) FILTER ({ISO_SQL} IS DISTINCT FROM start_date) AS modified FROM fx_enterprise")
def agg23(d):
    changed = rollups.changed_rows(F.col("start_date"), dates.iso_date(F.col("start_date")))
    return d.fx_enterprise.agg(F.count("*").alias("total"), changed.alias("modified"))


# --- order and pages -----------------------------------------------------------


@query("srt02_page_total", "SELECT num, status, (SELECT count(*) FROM fx_target) AS total FROM fx_target ORDER BY num LIMIT 50 OFFSET 20")
def srt02(d):
    t = d.fx_target.select("num", "status")
    return paging.with_total(paging.page(t, skip=20, limit=50), t)


@query("srt02b_seek_page", """SELECT id, num, reference FROM (SELECT *, row_number() OVER (ORDER BY id) AS place, count(*) OVER () AS n FROM fx_deposit)
WHERE place > n * 2 // 3 AND place <= n * 2 // 3 + 50""")
def srt02b(d):
    """A page deep inside all deposits, found by the number of rows in each key range."""
    table = paging.in_order(d.fx_deposit.select("id", "num", "reference"), "id", new_folder(d.spark, "ordered"), 16)
    total = table.ranges.agg(F.sum("rows")).first()[0]
    return paging.seek(table, skip=total * 2 // 3, limit=50)


@query("srt04_deposit_order", "SELECT id, num, period_year, deposit_date FROM fx_deposit ORDER BY period_year DESC, deposit_date DESC, id")
def srt04(d):
    return d.fx_deposit.select("id", "num", "period_year", "deposit_date").orderBy(F.desc("period_year"), F.desc("deposit_date"), "id")


@query("srt05_last_errors", "SELECT num, substr(error, 1, 90) AS error FROM fx_target WHERE status = 'error' ORDER BY num DESC LIMIT 5")
def srt05(d):
    e = d.fx_target.where("status = 'error'").orderBy(F.desc("num")).limit(5)
    return e.select("num", text.clip(F.col("error"), 90).alias("error"))


@query("srt07_run_cap", """SELECT num FROM fx_enterprise WHERE status = 'AC' AND num NOT IN (SELECT num FROM fx_checkpoint WHERE nbb = 'done') AND CAST(num AS BIGINT) % 4 = 1 ORDER BY num LIMIT 40""")
def srt07(d):
    left = entities.todo(d.fx_enterprise, d.fx_checkpoint, "nbb")
    return left.where(keys.in_shard(F.col("num"), 4, 1)).orderBy("num").limit(40)


@query("win13_newest", """SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 20""")
def win13(d):
    return paging.newest_first_then_oldest(d.events, "ts", "event_id").select("event_id", "event_type")
