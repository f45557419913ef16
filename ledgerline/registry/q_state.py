"""State tables, compositions, streaming."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.keys import in_shard
from ledgerline.operators import extract, html, merge, nest, paging, picks, rollups, search
from ledgerline.operators.outcomes import run_items
from ledgerline.operators.scale import fits
from ledgerline.plans import entities, reports, serving
from ledgerline.plans import finance as fin
from ledgerline.registry.book import query
from ledgerline.registry.inputs import _dotted, _num
from ledgerline.registry.q_archive import PUBS, card_items, card_rows, publication_items
from ledgerline.registry.q_finance import hotel_targets
from ledgerline.registry.q_register import (
    CHILD_COUNTS, CHILDREN, COUNT_COLS, DECODED, DEDUP_SQL, ISO_SQL, LABEL_CTE, NAMES_SQL, SECTOR_SQL, inlist, rich,
)
from ledgerline.constants import SECTOR_CODES
from ledgerline.registry.sqltext import FILINGS
from ledgerline.session import new_folder, stored
from ledgerline.streaming import refresh, tail

# --- upserts -------------------------------------------------------------------


def changes(d):
    """New rows for the supplier-based keys: part known, part new."""
    return d.supplier.select(
        F.lpad((F.col("s_suppkey") * 20).cast("string"), 10, "0").alias("num"), F.col("s_name").alias("denomination"),
        F.lit(9).alias("updated_run"))


CHANGES = f"(SELECT {_num('s_suppkey * 20')} AS num, s_name AS denomination, 9 AS updated_run FROM supplier)"


@query("mrg01_replace", f"""SELECT num, denomination, updated_run::DOUBLE AS updated_run FROM {CHANGES} UNION ALL
SELECT num, denomination, updated_run FROM fx_target WHERE num NOT IN (SELECT num FROM {CHANGES})""")
def mrg01(d):
    old = d.fx_target.select("num", "denomination", "updated_run")
    return merge.replace_rows(old, changes(d), ["num"]).withColumn("updated_run", F.col("updated_run").cast("double"))


@query("mrg02_insert_only_columns", f"""SELECT coalesce(t.num, c.num) AS num, CASE WHEN c.num IS NOT NULL THEN c.denomination ELSE t.denomination END AS denomination,
CASE WHEN t.num IS NULL THEN 'pending' ELSE t.status END AS status, CASE WHEN t.num IS NULL THEN 'new' ELSE 'old' END AS origin FROM fx_target t FULL JOIN {CHANGES} c ON t.num = c.num""")
def mrg02(d):
    old = d.fx_target.select("num", "status", "denomination", "updated_run").withColumn("origin", F.lit("old"))
    out = merge.upsert_targets(old, changes(d), {"status": F.lit("pending"), "origin": F.lit("new")})
    return out.select("num", "denomination", "status", "origin")


@query("mrg03_purge", """SELECT num, status FROM fx_target WHERE NOT coalesce(updated_run < 4 AND status IS DISTINCT FROM 'done', false)""")
def mrg03(d):
    return merge.purge(d.fx_target, F.lit(4)).select("num", "status")


@query("mrg03b_purged_count", "SELECT count(*) AS purged FROM fx_target WHERE updated_run < 4 AND status IS DISTINCT FROM 'done'")
def mrg03b(d):
    return d.fx_target.agg(F.count_if(merge.stale(F.col("updated_run"), F.lit(4), F.col("status"))).alias("purged"))


@query("mrg04_set_columns", f"""SELECT coalesce(t.num, c.num) AS num, CASE WHEN c.num IS NOT NULL THEN c.denomination ELSE t.denomination END AS denomination, t.status, t.error
FROM fx_target t FULL JOIN {CHANGES} c ON t.num = c.num""")
def mrg04(d):
    return merge.set_columns(d.fx_target, changes(d)).select("num", "denomination", "status", "error")


@query("mrg05_keep_existing", f"""SELECT num, denomination FROM fx_target UNION ALL SELECT num, denomination FROM {CHANGES} WHERE num NOT IN (SELECT num FROM fx_target)""")
def mrg05(d):
    merged = merge.keep_rows(d.fx_target.select("num", "denomination"), changes(d).select("num", "denomination"), ["num"])
    return merged


@query("mrg05b_copy_missing", """SELECT 'targets' AS name, false AS copied, count(*) AS rows FROM fx_target WHERE status = 'done'
UNION ALL SELECT 'checkpoints', true, count(*) FROM fx_checkpoint""")
def mrg05b(d):
    root = new_folder(d.spark, "copy")
    merge.copy_missing({"targets": d.fx_target.where("status = 'done'")}, root)
    copied = merge.copy_missing({"targets": d.fx_target, "checkpoints": d.fx_checkpoint}, root)
    counts = rollups.table_counts({n: d.spark.read.parquet(f"{root}/{n}") for n in ("targets", "checkpoints")})
    return counts.select("name", F.col("name").isin(copied).alias("copied"), "rows")


@query("mrg06_rebuild", "SELECT type_code, count(*) AS n FROM fx_denomination GROUP BY type_code")
def mrg06(d):
    root = new_folder(d.spark, "rebuild")
    for _ in range(2):  # a rebuild takes the place of what is there
        d.fx_denomination.select("num", "type_code").write.mode("overwrite").parquet(root)
    return d.spark.read.parquet(root).groupBy("type_code").agg(F.count("*").alias("n"))


MARKED = f"(SELECT {_num('s_suppkey')} AS num, CASE WHEN s_nationkey % 2 = 0 THEN 'done' ELSE 'empty' END AS st FROM supplier)"


@query("mrg07_checkpoint", f"""SELECT coalesce(k.num, m.num) AS num, k.nbb, CASE WHEN m.num IS NOT NULL THEN m.st ELSE k.ejustice END AS ejustice,
CASE WHEN m.num IS NOT NULL THEN 'run' END AS info_ejustice FROM fx_checkpoint k FULL JOIN {MARKED} m ON k.num = m.num""")
def mrg07(d):
    out = d.supplier.select(
        F.lpad(F.col("s_suppkey").cast("string"), 10, "0").alias("num"),
        F.when(F.col("s_nationkey") % 2 == 0, "done").otherwise("empty").alias("status"), F.lit("run").alias("info"))
    return merge.mark(d.fx_checkpoint, out, "ejustice")


RESULTS = "(SELECT num, count(*) AS filings, bool_or(language = 'NL' AND migration) AS failed FROM fx_deposit GROUP BY num)"


@query("mrg08_transitions", f"""SELECT t.num, CASE WHEN r.num IS NULL THEN t.status WHEN coalesce(r.failed, false) THEN 'error' ELSE 'done' END AS status,
coalesce(CASE WHEN r.num IS NOT NULL AND NOT coalesce(r.failed, false) THEN r.filings ELSE t.filings_count END, -1)::BIGINT AS filings_count,
CASE WHEN r.num IS NOT NULL AND coalesce(r.failed, false) THEN 'boom' ELSE t.error END AS error FROM fx_target t LEFT JOIN {RESULTS} r ON r.num = t.num""")
def mrg08(d):
    failed = F.coalesce(F.bool_or((F.col("language") == "NL") & F.col("migration")), F.lit(False))
    got = d.fx_deposit.groupBy("num").agg(F.count("*").alias("filings"), F.when(failed, "boom").alias("message"))
    got = got.withColumns({"scraped_at": F.current_timestamp(), "result": F.lit("{}")})
    out = merge.apply_outcomes(d.fx_target, got)
    return out.select("num", "status", F.coalesce(F.col("filings_count").cast("long"), F.lit(-1)).alias("filings_count"), "error")


@query("mrg09_todo", "SELECT num FROM fx_target WHERE status IS DISTINCT FROM 'done' AND CAST(num AS BIGINT) % 3 = 2")
def mrg09(d):
    return d.fx_target.where(~F.col("status").eqNullSafe("done")).where(in_shard(F.col("num"), 3, 2)).select("num")


@query("mrg09b_todo_totals", "SELECT count(*) AS total, count(*) FILTER (status IS DISTINCT FROM 'done') AS todo FROM fx_target")
def mrg09b(d):
    return d.fx_target.agg(F.count("*").alias("total"), F.count_if(~F.col("status").eqNullSafe("done")).alias("todo"))


@query("mrg10_force", """SELECT num, 'resume' AS mode FROM fx_enterprise WHERE status = 'AC' AND num NOT IN (SELECT num FROM fx_checkpoint WHERE ejustice = 'done')
UNION ALL SELECT num, 'force' FROM fx_enterprise WHERE status = 'AC'""")
def mrg10(d):
    a = entities.todo(d.fx_enterprise, d.fx_checkpoint, "ejustice").withColumn("mode", F.lit("resume"))
    return a.unionByName(entities.todo(d.fx_enterprise, d.fx_checkpoint, "ejustice", force=True).withColumn("mode", F.lit("force")))


@query("mrg11_union_renamed", "SELECT num, deposit_id AS id, reference FROM fx_account UNION ALL SELECT num, id, NULL FROM fx_deposit")
def mrg11(d):
    a = d.fx_account.select("num", F.col("deposit_id").alias("id"), "reference")
    return a.unionByName(d.fx_deposit.select("num", "id"), allowMissingColumns=True)


@query("flt19_empty_guard", "SELECT status, count(*) AS n FROM fx_target GROUP BY status")
def flt19(d):
    found = d.fx_target.where("status = 'unknown'")
    state = d.fx_target
    if not fits(found, 0):
        state = merge.set_columns(state, found)
    return state.groupBy("status").agg(F.count("*").alias("n"))


# --- compositions --------------------------------------------------------------


@query("prj04_entity_record", f"""SELECT e.num, n.nom_officiel, e.juridical_form, {COUNT_COLS} FROM fx_enterprise e {CHILD_COUNTS}
LEFT JOIN (SELECT num, valeur AS nom_officiel FROM fx_denomination WHERE type_code = '001' QUALIFY row_number() OVER (PARTITION BY num ORDER BY language, pos) = 1) n ON n.num = e.num""")
def prj04(d):
    flat = rich(d).counts().select("num", "juridical_form", *CHILDREN)
    return flat.join(picks.official_names(d.fx_denomination), "num", "left")


@query("flt21_point_lookup", f"SELECT e.num, e.status, {COUNT_COLS} FROM fx_enterprise e {CHILD_COUNTS} WHERE e.num = '0000000042'")
def flt21(d):
    one = rich(d).nested(["0000000042"])
    return one.select("num", "status", *[F.size(c).alias(c) for c in CHILDREN])


IN_REGISTER = "num IN (SELECT num FROM fx_enterprise)"


@query("prj09_key_inventory", f"""SELECT * FROM (SELECT 'codes.' || trim(replace(split_part(line, ',', 1), '"', '')) AS key, count(*) AS n FROM (
SELECT unnest(string_split(raw_csv, chr(10))[2:]) AS line FROM fx_account WHERE NOT coalesce(migration, false) AND trim(raw_csv) <> '') WHERE trim(line) <> '' GROUP BY 1
UNION ALL SELECT 'num', count(num) FROM fx_enterprise UNION ALL SELECT 'status', count(status) FROM fx_enterprise UNION ALL SELECT 'juridical_form', count(juridical_form) FROM fx_enterprise
UNION ALL SELECT 'fin_activite', count(CASE WHEN status = 'XX' THEN start_date END) FROM fx_enterprise
UNION ALL SELECT 'kbopub', count(*) FROM fx_branch WHERE {IN_REGISTER} UNION ALL SELECT 'kbopub.' || k, n FROM (
  SELECT unnest(['branch_id', 'branch_name']) AS k, unnest([count(branch_id), count(branch_name)]) AS n FROM fx_branch WHERE {IN_REGISTER})
UNION ALL SELECT unnest(['activites', 'activites.nace_code', 'activites.classification', 'activites.nace_version']), unnest([count(*), count(nace_code), count(classification), count(nace_version)])
  FROM fx_activity WHERE {IN_REGISTER}
UNION ALL SELECT unnest(['denominations', 'denominations.valeur']), unnest([count(*), count(valeur)]) FROM fx_denomination WHERE {IN_REGISTER}) WHERE n > 0""")
def prj09(d):
    card = d.fx_branch.select("num", F.struct("branch_id", "branch_name").alias("kbopub"))
    base = d.fx_enterprise.select("num", "status", "juridical_form", F.when(F.col("status") == "XX", F.col("start_date")).alias("fin_activite")).join(card, "num", "left")
    records = nest.record(base, {"activites": (d.fx_activity, ["nace_code", "classification", "nace_version"]), "denominations": (d.fx_denomination, ["valeur"])})
    codes = fin.csv_codes(fin.eligible(d.fx_account), ["deposit_id"])
    return reports.keys_in_use(records).unionByName(reports.map_keys_seen(codes, "codes"))


SILVER_SQL = f"""SELECT replace(e.enterprise_number, '.', '') AS num, e.status, {ISO_SQL} AS date_creation,
CAST(coalesce(dn.n, 0) AS INT) AS denominations, CAST(coalesce(ad.n, 0) AS INT) AS adresses, CAST(coalesce(ac.n, 0) AS INT) AS activites,
CAST(coalesce(dc.n, 0) AS INT) AS documents, CAST(coalesce(ca.n, 0) AS INT) AS comptes_annuels, cd.num IS NOT NULL AS has_kbopub, pb.num IS NOT NULL AS has_ejustice
FROM fx_enterprise e LEFT JOIN (SELECT num, count(*) AS n FROM fx_denomination GROUP BY num) dn ON dn.num = e.num
LEFT JOIN (SELECT num, count(*) AS n FROM fx_address WHERE type_of_address IN ('Siège', 'REGO') GROUP BY num) ad ON ad.num = e.num
LEFT JOIN (SELECT num, count(*) AS n FROM {DEDUP_SQL} GROUP BY num) ac ON ac.num = e.num
LEFT JOIN (SELECT enterprise AS num, count(*) AS n FROM fx_document GROUP BY enterprise) dc ON dc.num = e.num
LEFT JOIN (SELECT num, count(*) AS n FROM (SELECT num FROM fx_account UNION ALL SELECT num FROM fx_deposit) GROUP BY num) ca ON ca.num = e.num
LEFT JOIN (SELECT num FROM fx_branch) cd ON cd.num = e.num LEFT JOIN (SELECT DISTINCT num FROM fx_statute) pb ON pb.num = e.num"""


def silver(d):
    publications = d.fx_statute.groupBy("num").agg(F.count("*").alias("nb_publications"))
    second = d.fx_deposit.select("num", F.col("id").alias("deposit_id"), "reference", "period_year")
    return entities.silver(
        d.fx_enterprise, d.fx_activity, d.fx_address, d.fx_denomination, d.fx_document, [d.fx_account, second],
        cards=d.fx_branch, publications=publications)


@query("ent01_silver", SILVER_SQL)
def ent01(d):
    s = silver(d).counts()
    return s.select(
        "num", "status", "date_creation", "denominations", "adresses", "activites", "documents", "comptes_annuels",
        F.col("kbopub").isNotNull().alias("has_kbopub"), F.col("ejustice").isNotNull().alias("has_ejustice"))


@query("ent01e_silver_web", f"""SELECT {_num('c_custkey')} AS num, {_dotted('c_custkey')} AS numero, CASE WHEN c_custkey % 5 = 0 THEN c_name || ' SA' ELSE c_name END AS denomination,
CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) || ' EUR' AS capital, CAST(c_custkey % 12 AS INT) AS nb_etablissements, 'http://a.example/ejustice/' || CAST(c_custkey AS STRING) AS ejustice,
'/kbopub/' || {_num('c_custkey')} || '.html' AS archive, p.n AS nb_publications, k.pages FROM customer LEFT JOIN (SELECT num, count(*) AS n FROM ({PUBS}) GROUP BY num) p ON p.num = {_num('c_custkey')}
LEFT JOIN (SELECT {_num('o_custkey')} AS num, count(*) AS pages FROM orders GROUP BY 1) k ON k.num = {_num('c_custkey')}""")
def ent01e(d):
    """Silver with the records made from the archived card and publication pages."""
    items = card_items(d)
    cards = extract.card_records(d.fx_card_page, html.rows_of(items), html.links_of(items)).base
    publications = extract.publication_records(d.fx_pub_page, extract.publications(publication_items(d))).base
    s = entities.silver(d.fx_enterprise, d.fx_activity, d.fx_address, d.fx_denomination, d.fx_document, [d.fx_account], cards=cards, publications=publications)
    return s.base.select(
        "num", "kbopub.generalites.numero", "kbopub.generalites.denomination", "kbopub.donnees_financieres.capital", "kbopub.nb_etablissements",
        "kbopub.liens_externes.ejustice", "kbopub.archive", "ejustice.nb_publications", "ejustice.pages")


@query("ent01b_silver_children", f"""WITH c AS (SELECT num, 'denominations' AS child, valeur AS item FROM fx_denomination UNION ALL
SELECT num, 'adresses', street_nl FROM fx_address WHERE type_of_address IN ('Siège', 'REGO') UNION ALL SELECT num, 'activites', nace_code FROM {DEDUP_SQL} UNION ALL
SELECT enterprise, 'documents', path FROM fx_document UNION ALL SELECT num, 'comptes_annuels', CAST(deposit_id AS STRING) FROM fx_account UNION ALL
SELECT num, 'comptes_annuels', CAST(id AS STRING) FROM fx_deposit) SELECT num, child, item FROM c WHERE num IN (SELECT num FROM fx_enterprise)""")
def ent01b(d):
    s, shown = silver(d), {"denominations": "valeur", "adresses": "street_nl", "activites": "nace_code", "documents": "path", "comptes_annuels": "deposit_id"}
    parts = [s.rows(c).select("num", F.lit(c).alias("child"), F.col(f).cast("string").alias("item")) for c, f in shown.items()]
    return reduce(DataFrame.unionByName, parts)


def silver_of_rich(d):
    return entities.silver_of_rich(rich(d), d.fx_document, [d.fx_account], cards=d.fx_branch)


@query("ent01c_silver_activities", f"WITH {LABEL_CTE} SELECT num, nace_code, classification, nace_fr, nace_nl, group_fr FROM ({DECODED.format(t=DEDUP_SQL)}) x WHERE num IN (SELECT num FROM fx_enterprise)")
def ent01c(d):
    return silver_of_rich(d).rows("activites").select("num", "nace_code", "classification", "nace_fr", "nace_nl", "group_fr")


@query("ent01d_silver_rich_counts", """SELECT e.num, CAST(coalesce(c.n, 0) AS INT) AS contacts, CAST(coalesce(u.n, 0) AS INT) AS etablissements, CAST(coalesce(s.n, 0) AS INT) AS succursales,
CAST(coalesce(a.n, 0) AS INT) AS adresses FROM fx_enterprise e LEFT JOIN (SELECT num, count(*) AS n FROM fx_contact GROUP BY num) c ON c.num = e.num
LEFT JOIN (SELECT num, count(*) AS n FROM fx_establishment GROUP BY num) u ON u.num = e.num LEFT JOIN (SELECT num, count(*) AS n FROM fx_branch GROUP BY num) s ON s.num = e.num
LEFT JOIN (SELECT num, count(*) AS n FROM fx_address WHERE type_of_address IN ('Siège', 'REGO') GROUP BY num) a ON a.num = e.num""")
def ent01d(d):
    return silver_of_rich(d).counts().select("num", "contacts", "etablissements", "succursales", "adresses")


@query("ent02_rich", f"""WITH {LABEL_CTE} SELECT e.num, e.status, a.nace_code, a.classification, g.fr AS group_fr, c.nl AS classification_nl, n.fr AS nace_fr, n.nl AS nace_nl
FROM fx_enterprise e JOIN fx_activity a ON a.num = e.num LEFT JOIN labels g ON g.category = 'ActivityGroup' AND g.code = a.activity_group
LEFT JOIN labels c ON c.category = 'Classification' AND c.code = a.classification
LEFT JOIN labels n ON n.category = CASE WHEN coalesce(a.nace_version, '') = '' THEN 'Nace2008' ELSE 'Nace' || a.nace_version END AND n.code = a.nace_code
WHERE e.num NOT IN (SELECT num FROM fx_branch)""")
def ent02(d):
    r = rich(d, done=d.fx_branch).rows("activites", "status")
    return r.select("num", "status", "nace_code", "classification", "group_fr", "classification_nl", "nace_fr", "nace_nl")


SECTOR_CODES_CTE = f"""hit AS (SELECT num, string_agg(DISTINCT trim(nace_code), ',' ORDER BY trim(nace_code)) AS codes FROM fx_activity WHERE trim(classification) = 'MAIN' AND trim(nace_code) IN ({inlist(SECTOR_CODES)}) GROUP BY num)"""
ENT03 = f"""WITH sel AS ({SECTOR_SQL}),
hit AS (SELECT num, string_agg(DISTINCT trim(nace_code), ',' ORDER BY trim(nace_code)) AS codes FROM fx_activity WHERE trim(classification) = 'MAIN' AND trim(nace_code) IN ({inlist(SECTOR_CODES)}) GROUP BY num),
nm AS (SELECT num, valeur FROM fx_denomination QUALIFY row_number() OVER (PARTITION BY num ORDER BY pos) = 1)"""


def selected_targets(d):
    return entities.sector_list(d.fx_enterprise, d.fx_activity, d.fx_denomination)


@query("ent03_sector_targets", ENT03 + """, merged AS (SELECT coalesce(t.num, s.num) AS num, CASE WHEN t.num IS NULL THEN 'pending' ELSE t.status END AS status,
CASE WHEN s.num IS NOT NULL THEN nm.valeur ELSE t.denomination END AS denomination, hit.codes AS nace_codes, s.juridical_form,
CASE WHEN s.num IS NOT NULL THEN 6 ELSE t.updated_run END AS updated_run FROM fx_target t FULL JOIN sel s ON s.num = t.num LEFT JOIN hit ON hit.num = s.num LEFT JOIN nm ON nm.num = s.num)
SELECT num, status, denomination, nace_codes, juridical_form FROM merged WHERE NOT coalesce(updated_run < 6 AND status IS DISTINCT FROM 'done', false)""")
def ent03(d):
    out = entities.refresh_targets(d.fx_target, selected_targets(d), 6)
    return out.select("num", "status", "denomination", F.array_join("nace_codes", ",").alias("nace_codes"), "juridical_form")


@query("ent03b_matched_codes", ENT03 + " SELECT s.num, coalesce(hit.codes, '') AS nace_codes, s.juridical_form, nm.valeur AS denomination FROM sel s LEFT JOIN hit ON hit.num = s.num LEFT JOIN nm ON nm.num = s.num")
def ent03b(d):
    return selected_targets(d).withColumn("nace_codes", F.array_join("nace_codes", ","))


def decoded(category, col):
    return f"(SELECT coalesce(nullif(fr, ''), nullif(nl, '')) FROM labels WHERE category = '{category}' AND code = trim({col}))"


@query("ent04_translated", f"""WITH {LABEL_CTE}, seat AS (SELECT * FROM fx_address QUALIFY row_number() OVER (PARTITION BY num ORDER BY type_of_address = 'REGO' DESC, pos) = 1)
SELECT e.num, n.nom, coalesce({decoded('Status', 'e.status')}, e.status) AS statut, coalesce({decoded('JuridicalSituation', 'e.juridical_situation')}, e.juridical_situation) AS situation,
coalesce({decoded('JuridicalForm', 'e.juridical_form')}, e.juridical_form) AS forme, coalesce({decoded('TypeOfEnterprise', 'e.type_of_enterprise')}, e.type_of_enterprise) AS type_entreprise,
e.start_date AS date_creation, trim(coalesce(nullif(s.street_fr, ''), s.street_nl, '') || ' ' || s.house_number || ', ' || s.zipcode || ' ' || coalesce(s.municipality_fr, ''), ', ') AS adresse,
coalesce({decoded('TypeOfAddress', 's.type_of_address')}, s.type_of_address) AS type_adresse, coalesce(b.n, 0) AS nb_etablissements
FROM fx_enterprise e LEFT JOIN {NAMES_SQL} n ON n.num = e.num LEFT JOIN seat s ON s.num = e.num LEFT JOIN (SELECT num, count(*) AS n FROM fx_establishment GROUP BY num) b ON b.num = e.num""")
def ent04(d):
    return entities.translated(d.fx_enterprise, d.fx_denomination, d.fx_address, d.fx_establishment, d.fx_code, "FR")


DISPLAY = "(SELECT num, coalesce(arg_min(valeur, pos) FILTER (type_code = '001'), arg_min(valeur, pos)) AS denomination FROM fx_denomination WHERE coalesce(valeur, '') <> '' GROUP BY num)"
TOKENS = "list_has_any(regexp_split_to_array(lower(valeur), '[^\\p{L}\\p{N}_]+'), ['customer', '1'])"


def ent05_sql(where, tail_sql):
    return f"""SELECT e.num, e.juridical_form, e.status, n.denomination, e.num IN (SELECT num FROM fx_filing_line) AS has_gold
FROM (SELECT * FROM fx_enterprise WHERE {where} ORDER BY num {tail_sql}) e LEFT JOIN {DISPLAY} n ON n.num = e.num"""


def directory(d, **kw):
    return serving.enterprise_page(d.fx_enterprise, d.fx_denomination, d.fx_filing_line.select("num"), **kw)


@query("ent05_directory_all", ent05_sql("true", "LIMIT 50 OFFSET 30"))
def ent05(d):
    return directory(d, skip=30)


@query("ent05b_directory_number", ent05_sql("starts_with(num, '0000000')", "LIMIT 200"))
def ent05b(d):
    return directory(d, text="0000.000", skip=30, limit=200)


@query("ent05c_directory_name", ent05_sql(f"num IN (SELECT num FROM fx_denomination WHERE {TOKENS})", "LIMIT 50"))
def ent05c(d):
    return directory(d, text="Customer 1")


def name_tokens(d):
    return d.derived("name_tokens", lambda: search.token_table(d.fx_denomination, "num", "valeur"), "word")


@query("ent05d_directory_name_table", ent05_sql(f"num IN (SELECT num FROM fx_denomination WHERE {TOKENS})", "LIMIT 50"))
def ent05d(d):
    return directory(d, text="Customer 1", names=name_tokens(d))


def ent06_sql(where):
    return f"""WITH {FILINGS}, last AS (SELECT num, year, ca, resultat_net FROM growth QUALIFY row_number() OVER (PARTITION BY num ORDER BY year DESC) = 1),
cnt AS (SELECT num, count(*) AS n, CASE WHEN bool_or(ca IS NOT NULL) THEN 'full' WHEN bool_or(fonds_propres IS NOT NULL) THEN 'abrege' ELSE 'micro' END AS schema_type
FROM growth GROUP BY num), hits AS (SELECT * FROM fx_target WHERE {where})
SELECT t.num, coalesce(d.denomination, t.denomination) AS denomination, t.status, coalesce(cnt.n, 0) AS nb_exercices, last.year AS dernier_exercice, round(last.ca, 2) AS ca,
round(last.resultat_net, 2) AS resultat_net, cnt.n IS NOT NULL AS has_gold, substr(t.denomination, 1, 4) AS nace_codes, cnt.schema_type, (SELECT count(*) FROM hits) AS total
FROM (SELECT * FROM hits ORDER BY num LIMIT 50 OFFSET 10) t LEFT JOIN last ON last.num = t.num LEFT JOIN cnt ON cnt.num = t.num LEFT JOIN {DISPLAY} d ON d.num = t.num"""


def sector_page(d, text):
    targets = d.fx_target.withColumn("nace_codes", F.substring("denomination", 1, 4))
    out = serving.target_page(targets, d.fx_filing_line, d.fx_denomination, text=text, skip=10, names=name_tokens(d) if text else None)
    return out.withColumns({"ca": F.round("ca", 2), "resultat_net": F.round("resultat_net", 2)})


@query("ent06_sector_page", ent06_sql("true"))
def ent06(d):
    return sector_page(d, "")


@query("ent06c_sector_page_stored", f"""WITH {SECTOR_CODES_CTE}, {FILINGS}, cnt AS (SELECT num, count(*) AS n FROM growth GROUP BY num),
hits AS (SELECT num, CASE WHEN num LIKE '%7' THEN NULL ELSE denomination END AS denomination, denomination AS gold_name, status FROM fx_target)
SELECT t.num, coalesce(d.denomination, t.denomination, 'gold ' || t.gold_name) AS denomination, t.status, coalesce(cnt.n, 0) AS nb_exercices, coalesce(hit.codes, '') AS nace_codes, (SELECT count(*) FROM hits) AS total
FROM (SELECT * FROM hits ORDER BY num LIMIT 200 OFFSET 10) t LEFT JOIN cnt ON cnt.num = t.num LEFT JOIN hit ON hit.num = t.num LEFT JOIN {DISPLAY} d ON d.num = t.num AND t.num NOT LIKE '%77'""")
def ent06c(d):
    """The page with the codes stored with the targets; a name missing there and in the register comes from gold."""
    def stored_targets():
        name = F.when(~F.col("num").endswith("7"), F.col("denomination"))
        return d.fx_target.join(entities.matched_codes(d.fx_activity), "num", "left").withColumn("denomination", name)

    named = d.fx_denomination.where(~F.col("num").endswith("77"))
    gold_names = d.fx_target.select("num", F.concat(F.lit("gold "), "denomination").alias("gold_name"))
    out = serving.target_page(d.derived("coded_targets", stored_targets), d.fx_filing_line, named, skip=10, limit=200, gold_names=gold_names)
    return out.select("num", "denomination", "status", "nb_exercices", F.coalesce(F.array_join("nace_codes", ","), F.lit("")).alias("nace_codes"), "total")


@query("jn10_page_enrichment", ent06_sql("starts_with(num, '00000000')"))
def jn10(d):
    return sector_page(d, "00000000")


@query("ent06b_sector_page_name", ent06_sql(f"num IN (SELECT DISTINCT num FROM fx_denomination WHERE {TOKENS})"))
def ent06b(d):
    return sector_page(d, "customer 1")


PROFILE = f"""WITH {FILINGS}, g AS (SELECT num, count(*) AS n, CASE WHEN bool_or(ca IS NOT NULL) THEN 'full' WHEN bool_or(fonds_propres IS NOT NULL) THEN 'abrege' ELSE 'micro' END AS schema_type FROM growth GROUP BY num),
adr AS (SELECT num, nullif(concat_ws(', ', nullif(concat_ws(' ', nullif(street_fr, ''), nullif(house_number, '')), ''), nullif(concat_ws(' ', nullif(zipcode, ''), nullif(municipality_fr, '')), '')), '') AS adresse
FROM fx_address WHERE type_of_address IN ('Siège', 'REGO') QUALIFY row_number() OVER (PARTITION BY num ORDER BY pos) = 1),
sv AS (SELECT e.*, adr.adresse, d.denomination FROM fx_enterprise e LEFT JOIN adr ON adr.num = e.num LEFT JOIN {DISPLAY} d ON d.num = e.num)
SELECT coalesce(g.num, sv.num) AS num, coalesce(sv.denomination, substr(t.denomination, 1)) AS denomination, sv.juridical_form, sv.status, sv.adresse, g.schema_type, coalesce(CAST(g.n AS INT), 0) AS nb_exercices,
g.num IS NOT NULL AS in_gold, sv.num IS NOT NULL AS in_register, c.branch_name FROM g FULL JOIN sv ON sv.num = g.num LEFT JOIN fx_target t ON t.num = g.num LEFT JOIN fx_branch c ON c.num = coalesce(g.num, sv.num)"""


def profile(d):
    targets = hotel_targets(d)
    g = fin.gold(fin.yearly_metrics(d.fx_filing_line), targets)
    p = entities.profiles(g, d.fx_enterprise, d.fx_denomination, d.fx_address, d.fx_branch)
    return p.select("num", "denomination", "juridical_form", "status", "adresse", "schema_type", F.coalesce("nb_exercices", F.lit(0)).alias("nb_exercices"), "in_gold", "in_register", "branch_name")


query("jn13_profile_join", PROFILE)(profile)


@query("ent07_profile", f"""WITH p AS ({PROFILE.replace('WITH ' + FILINGS + ',', 'WITH ' + FILINGS + ',')}),
a AS (SELECT num, count(*) AS n FROM fx_activity GROUP BY num)
SELECT p.num, p.denomination, p.adresse, p.nb_exercices, coalesce(a.n, 0) AS activites, CASE WHEN c.c_custkey IS NULL THEN 0 ELSE 2 END AS dirigeants,
CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) || ' EUR' AS capital FROM p LEFT JOIN a ON a.num = p.num LEFT JOIN customer c ON {_num('c.c_custkey')} = p.num""")
def ent07(d):
    rows = card_rows(d)
    fields = extract.card_fields(extract.label_values(rows), d.fx_card_page).select("num", "capital")
    officers = entities.officer_list(extract.officers(extract.with_section(rows)), d.fx_denomination)
    out = profile(d).select("num", "denomination", "adresse", "nb_exercices").join(fields, "num", "left")
    out = rollups.zero_filled(out, d.fx_activity.groupBy("num").agg(F.count("*").alias("activites")), "num", "activites")
    counts = officers.groupBy("num").agg(F.count("*").cast("int").alias("dirigeants"))
    return rollups.zero_filled(out, counts, "num", "dirigeants")


def profile_record(d):
    """The profile of every enterprise with its activities, officers and years as long tables."""
    items = card_items(d)
    cards = extract.card_records(d.fx_card_page, html.rows_of(items), html.links_of(items))
    return entities.profile_record(
        d.fx_enterprise, d.fx_activity, d.fx_code, cards.children["fonctions"].withColumn("row_no", F.col("pos")), d.fx_denomination,
        fin.yearly_metrics(d.fx_filing_line, hotel_targets(d)), cards)


@query("ent07b_profile_activities", f"WITH {LABEL_CTE} SELECT num, nace_code, classification, nace_fr, nace_nl, classification_fr FROM ({DECODED.format(t='fx_activity')}) x WHERE num IN (SELECT num FROM fx_enterprise)")
def ent07b(d):
    return profile_record(d).rows("activites").select("num", "nace_code", "classification", "nace_fr", "nace_nl", "classification_fr")


@query("ent07c_profile_officers", f"""WITH n AS {DISPLAY} SELECT {_num('c.c_custkey')} AS num, 10 AS pos, 'Administrateur' AS fonction, coalesce(n.denomination, {_dotted('c.c_nationkey * 3')}) AS nom,
{_num('c.c_nationkey * 3')} AS ref_bce, true AS is_company FROM customer c LEFT JOIN n ON n.num = {_num('c.c_nationkey * 3')}
UNION ALL SELECT {_num('c_custkey')}, 11, 'Gérant', 'Dupont , ' || c_mktsegment, NULL, false FROM customer""")
def ent07c(d):
    return profile_record(d).rows("dirigeants").select("num", "pos", "fonction", "nom", "ref_bce", "is_company")


@query("ent07d_profile_years", f"""WITH {FILINGS} SELECT num, CAST(row_number() OVER (PARTITION BY num ORDER BY year) AS INT) AS pos, year, round(ca, 2) AS ca, round(resultat_net, 2) AS resultat_net
FROM growth WHERE num IN (SELECT num FROM fx_target) AND num IN (SELECT num FROM fx_enterprise)""")
def ent07d(d):
    years = profile_record(d).rows("annees")
    return years.select("num", "pos", "year", F.round("ca", 2).alias("ca"), F.round("resultat_net", 2).alias("resultat_net"))


@query("ent07e_profile_card", f"""SELECT {_num('c_custkey')} AS num, CAST(1 + c_custkey % 2 AS STRING) AS type_of_enterprise, {_dotted('c_custkey')} AS numero, NULL::VARCHAR AS email,
CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) || ' EUR' AS capital, 'http://consult.cbso.nbb.be/' || CAST(c_custkey AS STRING) AS nbb, CAST(c_custkey % 12 AS INT) AS nb_etablissements,
CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 1 END AS liens_entites, 2 AS dirigeants FROM customer""")
def ent07e(d):
    """The card's part of every profile: contact, financial data, links, and how many linked entities and officers."""
    p = profile_record(d)
    p = p._replace(children={n: p.children[n] for n in ("liens_entites", "dirigeants")})
    return p.counts().select(
        "num", "type_of_enterprise", "generalites.numero", "contact.email", "donnees_financieres.capital", "liens_externes.nbb", "nb_etablissements", "liens_entites", "dirigeants")


@query("ent07f_profile_page", f"""WITH {FILINGS}, n AS {DISPLAY}, a AS (SELECT num, count(*) AS n FROM fx_activity GROUP BY num),
y AS (SELECT num, count(*) AS n, max(year) AS last, list(ca ORDER BY year DESC)[1] AS ca FROM growth WHERE num IN (SELECT num FROM fx_target) GROUP BY num)
SELECT e.num, e.status, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) || ' EUR' AS capital, CAST(coalesce(a.n, 0) AS INT) AS activites, 2 AS dirigeants,
coalesce(n.denomination, {_dotted('c.c_nationkey * 3')}) AS premier_dirigeant, CAST(coalesce(y.n, 0) AS INT) AS annees, y.last AS derniere_annee, round(y.ca, 2) AS ca,
CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE {_num('c.c_nationkey')} END AS lien FROM (SELECT * FROM fx_enterprise ORDER BY num LIMIT 20 OFFSET 5) e JOIN customer c ON {_num('c.c_custkey')} = e.num
LEFT JOIN a ON a.num = e.num LEFT JOIN y ON y.num = e.num LEFT JOIN n ON n.num = {_num('c.c_nationkey * 3')}""")
def ent07f(d):
    """Whole profiles of one page of enterprises, with their lists in order."""
    keys = [r["num"] for r in paging.page(d.fx_enterprise.select("num"), skip=5, limit=20).collect()]
    shown = profile_record(d).nested(keys)
    last = F.try_element_at("annees", F.lit(-1))
    return shown.select(
        "num", "status", "donnees_financieres.capital", F.size("activites").alias("activites"), F.size("dirigeants").alias("dirigeants"),
        F.get("dirigeants", F.lit(0))["nom"].alias("premier_dirigeant"), F.size("annees").alias("annees"), last["year"].alias("derniere_annee"), F.round(last["ca"], 2).alias("ca"),
        F.get("liens_entites", F.lit(0))["bce"].alias("lien"))


@query("ent08_progress", """SELECT 'cibles' AS metric, count(*)::DOUBLE AS value FROM fx_target UNION ALL SELECT 'done', count(*) FROM fx_target WHERE status = 'done'
UNION ALL SELECT 'pending', count(*) FROM fx_target WHERE status = 'pending' UNION ALL SELECT 'error', count(*) FROM fx_target WHERE status = 'error'
UNION ALL SELECT 'pct', round(100.0 * count(*) FILTER (status IN ('done', 'error')) / count(*), 1) FROM fx_target
UNION ALL SELECT 'filings', sum(filings_count) FROM fx_target WHERE status = 'done' UNION ALL SELECT 'done_without_filing', count(*) FROM fx_target WHERE status = 'done' AND filings_count = 0
UNION ALL SELECT 'documents', count(*) FROM fx_document UNION ALL SELECT 'documents_nbb', count(*) FROM fx_document WHERE source = 'nbb'
UNION ALL SELECT 'documents_notaire', count(*) FROM fx_document WHERE source = 'notaire' UNION ALL SELECT 'comptes', count(*) FROM fx_account UNION ALL SELECT 'fiches', count(*) FROM fx_enterprise""")
def ent08(d):
    return reports.progress(d.fx_target, d.fx_document, d.fx_account, d.fx_enterprise)


# --- streams and outcomes ------------------------------------------------------


def event_path(d):
    """The events table as a file source path (a glob also takes a single file)."""
    return f"{d.sf}/events.parque[t]"


EVENTS = "SELECT event_id, user_id, event_type, round(value, 2) AS value FROM events"


def event_rows(df):
    return df.select("event_id", "user_id", "event_type", F.round("value", 2).alias("value"))


@query("stm01_tail", EVENTS)
def stm01(d):
    target, ck = new_folder(d.spark, "tail"), new_folder(d.spark, "ck")
    tail.drain(tail.follow(d.spark, event_path(d), d.events.schema), target, ck)
    return event_rows(d.spark.read.schema(d.events.schema).parquet(target))


def halves(d):
    half = F.col("event_id") * 2 < d.events.agg(F.count("*")).scalar()
    return d.events.where(half), d.events.where(~half)


@query("stm02_snapshot_then_follow", """WITH n AS (SELECT count(*) AS n FROM events), a AS (SELECT e.* FROM events e, n WHERE event_id * 2 < n.n)
SELECT event_id, 'snapshot' AS phase FROM (SELECT * FROM a ORDER BY ts DESC, event_id DESC LIMIT 20)
UNION ALL SELECT event_id, 'follow' FROM events, n WHERE event_id * 2 >= n.n""")
def stm02(d):
    source, state, target, ck = (new_folder(d.spark, n) for n in ("grow", "newest", "follow", "ck"))
    early, late = halves(d)
    early.write.mode("append").parquet(source)
    shown = tail.snapshot(d.spark, source, d.events.schema, "ts", "event_id", state, ck).select("event_id")
    late.write.mode("append").parquet(source)
    tail.deliver(tail.follow(d.spark, source, d.events.schema), target, ck)
    followed = tail.delivered(d.spark, target, d.events.schema)
    return shown.withColumn("phase", F.lit("snapshot")).unionByName(followed.select("event_id", F.lit("follow").alias("phase")))


@query("stm03_end_when_idle", "SELECT count(*) AS rows, false AS active FROM events")
def stm03(d):
    target, ck = new_folder(d.spark, "tail"), new_folder(d.spark, "ck")
    q = tail.follow_until_idle(tail.follow(d.spark, event_path(d), d.events.schema), target, ck)
    out = tail.delivered(d.spark, target, d.events.schema)
    return out.agg(F.count("*").alias("rows"), F.lit(q.isActive).alias("active"))


@query("stm04_filtered_payloads", """SELECT '{"event_id":' || CAST(event_id AS STRING) || ',"event_type":"' || event_type || '"}' AS payload FROM events WHERE event_type = 'click'""")
def stm04(d):
    target, ck = new_folder(d.spark, "payload"), new_folder(d.spark, "ck")
    stream = tail.follow(d.spark, event_path(d), d.events.schema)
    tail.drain(tail.payloads(stream, ["event_id", "event_type"], event_type="click", user_id=None), target, ck)
    return d.spark.read.schema("payload string").parquet(target)


@query("stm05_resumable_upsert", """SELECT user_id, event_id, event_type, 0 AS added_by_second_run FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def stm05(d):
    source, changes, ck = new_folder(d.spark, "grow"), new_folder(d.spark, "changes"), new_folder(d.spark, "ck")
    d.events.repartition(4).write.parquet(source)
    rows = tail.follow(d.spark, source, d.events.schema, files_per_batch=1).select("user_id", "ts", "event_id", "event_type")
    run = lambda: refresh.keep_latest(rows, ["user_id"], ["ts", "event_id"], changes, ck)
    run()
    again = run()
    state = refresh.latest_rows(d.spark, changes, rows.schema, ["user_id"])
    return state.select("user_id", "event_id", "event_type", F.lit(again + 1).alias("added_by_second_run"))


@query("stm06_batch_summaries", "SELECT event_type, CAST(count(*) AS BIGINT) AS rows FROM events GROUP BY event_type")
def stm06(d):
    source, target, ck = new_folder(d.spark, "grow"), new_folder(d.spark, "summary"), new_folder(d.spark, "ck")
    d.events.repartition(3).write.parquet(source)
    refresh.batch_summaries(tail.follow(d.spark, source, d.events.schema, files_per_batch=1), target, ck, "event_type")
    return d.spark.read.parquet(target).groupBy("event_type").agg(F.sum("rows").alias("rows"))


@query("stm07_gold_refresh", f"""WITH {FILINGS} SELECT g.num, CASE WHEN bool_or(ca IS NOT NULL) THEN 'full' WHEN bool_or(fonds_propres IS NOT NULL) THEN 'abrege' ELSE 'micro' END AS schema_type,
CAST(count(*) AS INT) AS nb_exercices, max(t.denomination) AS denomination FROM growth g JOIN fx_target t ON t.num = g.num GROUP BY g.num""")
def stm07(d):
    """Gold of the done targets, made before the filings of some references came; then their change is carried on."""
    targets = d.fx_target.withColumn("nace_codes", F.lit(None).cast("string"))
    done = targets.where("status = 'done'")
    lines = d.fx_filing_line
    late = F.col("reference").endswith("7")
    old = refresh.open_books(lines.where(~late))
    books = refresh.Books(stored(old.filings, "filings"), stored(old.yearly, "yearly"))
    gold = stored(fin.gold(books.yearly.join(done.select("num"), "num", "left_semi"), done), "gold")
    books, changed = refresh.carry_on(books, lines, lines.where(late), stored)
    out = refresh.refresh_gold(gold, books, changed, targets)
    return out.select("num", "schema_type", "nb_exercices", "denomination")


@query("udf01_run_items", "SELECT num, CASE WHEN status = 'ST' THEN 'error' ELSE 'ok:' || status END AS outcome, CASE WHEN status = 'ST' THEN 'stopped ' || num END AS error FROM fx_enterprise")
def udf01(d):
    def handle(context, row):
        if row.status == "ST":
            raise ValueError(f"stopped {row.num}")
        return context + row.status

    return run_items(d.fx_enterprise.select("num", "status"), lambda: "ok:", handle)


@query("udf02_error_capture", "SELECT CASE WHEN TRY_CAST(start_date AS DATE) IS NULL THEN 'error' ELSE 'ok' END AS outcome, count(*) AS n FROM fx_enterprise GROUP BY 1")
def udf02(d):
    parsed = F.try_to_timestamp("start_date", F.lit("yyyy-MM-dd"))
    return d.fx_enterprise.groupBy(F.when(parsed.isNull(), "error").otherwise("ok").alias("outcome")).agg(F.count("*").alias("n"))
