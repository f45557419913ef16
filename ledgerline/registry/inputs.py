"""Register tables derived from the given parquet tables.

Every view is one SQL text used by Spark and, as a CTE, by the checking SQL. Two
markers differ per engine: ``@row(..)`` (an orderable composite position, so no
numbering window is needed) and ``@each(name: v, ..)`` (one output row per listed value).
Views keep all rows of the tables they read.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import drop_intermediates
from ledgerline.sources.landing import TASK_BYTES, Landed, bucket_number, land, source_bytes

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _num(key: str) -> str:
    return f"lpad(CAST({key} AS STRING), 10, '0')"


def _dotted(key: str) -> str:
    n = _num(key)
    return f"substr({n}, 1, 4) || '.' || substr({n}, 5, 3) || '.' || substr({n}, 8, 3)"


DAY = "substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 10)"
YMD = f"CAST(replace({DAY}, '-', '') AS BIGINT)"
MONEY = "CAST(o_totalprice AS DECIMAL(18,2))"
REFERENCE = f"substr({DAY}, 1, 4) || '-' || lpad(CAST(o_orderkey AS STRING), 8, '0')"

VIEWS: dict[str, str] = {
    "fx_enterprise": f"""
SELECT {_num('c_custkey')} AS num, {_dotted('c_custkey')} AS enterprise_number,
       CASE WHEN c_custkey % 10 = 0 THEN 'ST' ELSE 'AC' END AS status,
       CASE WHEN c_custkey % 3 = 0 THEN '000' ELSE '012' END AS juridical_situation,
       CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_nationkey % 5 = 0 THEN '110' WHEN c_nationkey % 5 = 1 THEN '412'
            WHEN c_nationkey % 5 = 2 THEN '610' WHEN c_nationkey % 5 = 3 THEN '014' ELSE '017' END AS juridical_form,
       CAST(1 + c_custkey % 2 AS STRING) AS type_of_enterprise,
       CASE WHEN c_custkey % 7 = 0 THEN '20' || lpad(CAST(c_custkey % 24 AS STRING), 2, '0') || '-03-09'
            WHEN c_custkey % 31 = 0 THEN NULL
            ELSE lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0') || '-' || lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0')
              || '-' || CAST(1980 + c_custkey % 40 AS STRING) END AS start_date
FROM customer""",
    "fx_denomination": f"""
SELECT {_num('c_custkey')} AS num, CAST(lang AS STRING) AS language,
       CASE WHEN (c_custkey + lang) % 4 = 0 OR c_custkey % 17 = 0 THEN '003' ELSE '001' END AS type_code,
       CASE WHEN c_custkey % 13 = 0 AND lang = 1 THEN '' WHEN c_custkey % 51 = 0 THEN NULL
            ELSE c_name || '/' || CAST(lang AS STRING) END AS valeur,
       lang AS pos
FROM customer @each(lang: 0, 1, 2)""",
    "fx_address": f"""
SELECT {_num('c_custkey')} AS num,
       CASE WHEN pos = 0 THEN 'BAET' WHEN c_custkey % 9 = 0 THEN 'ABBR' ELSE 'REGO' END AS type_of_address, pos,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'Rue ' || n_name END AS street_fr, n_name || 'straat' AS street_nl,
       CAST(c_custkey % 200 AS STRING) AS house_number, CAST(1000 + c_nationkey * 10 AS STRING) AS zipcode,
       CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 'Ville ' || r_name END AS municipality_fr, r_name AS municipality_nl
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey @each(pos: 0, 1)""",
    "fx_activity": f"""
SELECT {_num('o_custkey')} AS num,
       CASE l_linenumber % 4 WHEN 0 THEN '2003' WHEN 1 THEN '2008' WHEN 2 THEN '2025' ELSE '' END AS nace_version,
       CASE l_partkey % 20 WHEN 0 THEN '55100' WHEN 1 THEN '55201' WHEN 2 THEN '55203' WHEN 3 THEN '55300' WHEN 4 THEN '55900'
            ELSE CAST(70000 + l_partkey % 1000 AS STRING) END AS nace_code,
       CASE WHEN l_returnflag = 'R' AND l_suppkey % 9 = 0 THEN 'MAIN ' WHEN l_returnflag = 'R' THEN 'MAIN'
            WHEN l_partkey % 50 = 7 THEN NULL ELSE 'SECO' END AS classification,
       l_linestatus AS activity_group, @row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus, l_returnflag) AS pos
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fx_contact": f"""
SELECT {_num('c_custkey')} AS num,
       CASE WHEN (c_custkey + pos) % 3 = 1 THEN 'FAX' WHEN pos = 0 THEN 'TEL' WHEN pos = 1 THEN 'EMAIL' ELSE 'WEB' END AS contact_type,
       c_mktsegment || ':' || CAST(c_custkey AS STRING) || '/' || CAST(pos AS STRING) AS value, pos
FROM customer @each(pos: 0, 1, 2)""",
    "fx_establishment": f"""
SELECT {_num('o_custkey')} AS num, '2.' || lpad(CAST(o_orderkey AS STRING), 9, '0') AS establishment_number,
       {DAY} AS start_date
FROM orders""",
    "fx_branch": f"""
SELECT {_num('s_suppkey')} AS num, '9.' || lpad(CAST(s_suppkey AS STRING), 9, '0') AS branch_id, s_name AS branch_name
FROM supplier""",
    "fx_code": """
SELECT CASE WHEN kind IN (0, 2) THEN 'Nace2008' WHEN kind = 1 THEN 'Nace2025' WHEN kind = 3 THEN 'Classification'
            WHEN kind = 4 THEN 'ActivityGroup' WHEN kind = 5 THEN 'JuridicalForm' WHEN kind = 6 THEN 'Status'
            WHEN kind = 7 THEN 'TypeOfEnterprise' WHEN kind = 8 THEN 'TypeOfAddress' ELSE 'JuridicalSituation' END AS category,
       CASE WHEN kind IN (0, 1) THEN CAST(70000 + p_partkey % 1000 AS STRING)
            WHEN kind = 2 THEN CASE p_partkey % 3 WHEN 0 THEN '55100' WHEN 1 THEN '55300' ELSE '55900' END
            WHEN kind = 3 THEN CASE WHEN p_size % 2 = 0 THEN 'MAIN' ELSE 'SECO' END
            WHEN kind = 4 THEN CASE WHEN p_size % 2 = 0 THEN 'O' ELSE 'F' END
            WHEN kind = 5 THEN CASE p_size % 3 WHEN 0 THEN '110' WHEN 1 THEN '412' ELSE '014' END
            WHEN kind = 6 THEN CASE WHEN p_size % 2 = 0 THEN 'AC' ELSE 'ST' END
            WHEN kind = 7 THEN CAST(1 + p_size % 2 AS STRING)
            WHEN kind = 8 THEN CASE WHEN p_size % 2 = 0 THEN 'REGO' ELSE 'BAET' END ELSE '000' END AS code,
       CASE WHEN kind = 1 THEN 'NL' WHEN kind = 3 AND p_size % 2 = 1 THEN 'NL' WHEN kind = 4 AND p_size % 2 = 0 THEN 'FR'
            WHEN p_partkey % 4 < 2 THEN 'FR' ELSE 'NL' END AS language,
       CASE WHEN kind = 2 AND p_partkey % 7 = 0 THEN '' ELSE p_name || ' ' || CAST(kind AS STRING) || '.' || CAST(p_partkey AS STRING) END AS description,
       p_partkey AS pos
FROM part @each(kind: 0, 1, 2, 3, 4, 5, 6, 7, 8, 9)""",
    "fx_deposit": f"""
SELECT o_orderkey AS id, {_num('o_custkey')} AS num,
       CASE WHEN o_orderkey % 29 = 0 THEN 'X' || CAST(o_orderkey AS STRING) WHEN o_orderkey % 97 = 0 THEN NULL
            ELSE {REFERENCE} END AS reference,
       CAST(substr({DAY}, 1, 4) AS INT) - CAST(o_orderkey % 2 AS INT) AS period_year,
       CASE WHEN o_orderkey % 58 = 0 THEN NULL ELSE {DAY} END AS deposit_date,
       CASE o_orderkey % 3 WHEN 0 THEN 'FR' WHEN 1 THEN 'NL' ELSE NULL END AS language,
       CASE WHEN o_orderkey % 7 = 0 THEN 'mc-f' WHEN o_orderkey % 17 = 0 THEN NULL ELSE 'm02-f' END AS model_code,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 5 = 0 END AS migration,
       @row(-{YMD}, o_orderkey) AS pos
FROM orders""",
    "fx_filing_line": f"""
SELECT {_num('o_custkey')} AS num, {REFERENCE} AS reference,
       CASE WHEN l_linenumber = 1 THEN '70' WHEN l_linenumber = 2 THEN CASE WHEN l_partkey % 3 = 0 THEN '71' ELSE '60' END
            WHEN l_linenumber = 3 THEN CASE WHEN l_partkey % 5 = 0 THEN '9900' ELSE '9901' END
            WHEN l_linenumber = 4 THEN CASE WHEN l_partkey % 4 = 0 THEN '9903' ELSE '9904' END
            WHEN l_linenumber = 5 THEN CASE WHEN l_partkey % 4 = 0 THEN '100' ELSE '10/15' END
            WHEN l_linenumber = 6 THEN CASE l_partkey % 4 WHEN 0 THEN '54' WHEN 1 THEN '55' WHEN 2 THEN '54/58' ELSE '20/58' END
            ELSE CASE l_partkey % 6 WHEN 0 THEN '17' WHEN 1 THEN '43' WHEN 2 THEN '42/48' WHEN 3 THEN '630' WHEN 4 THEN '670/3'
                 ELSE 'Accounting period end date' END END AS code,
       CASE WHEN l_linenumber = 7 AND l_partkey % 6 = 5 THEN CAST(CAST(substr({DAY}, 1, 4) AS INT) - CAST(l_partkey % 3 AS INT) AS STRING) || '-12-31'
            WHEN l_partkey % 41 = 0 THEN '-' WHEN l_partkey % 43 = 0 THEN ''
            WHEN l_partkey % 47 = 0 THEN CASE l_suppkey % 4 WHEN 0 THEN 'abc' WHEN 1 THEN '1d' WHEN 2 THEN '1.234.567' ELSE '.' END
            WHEN l_partkey % 11 = 0 THEN '(' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) || ')'
            WHEN l_partkey % 13 = 0 THEN replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING), '.', ',')
            WHEN l_partkey % 17 = 0 THEN '1.' || lpad(CAST(l_suppkey % 1000 AS STRING), 3, '0') || ',' || CAST(l_linenumber AS STRING)
            WHEN l_partkey % 19 = 0 THEN ' ' || CAST(CAST(l_quantity AS INT) AS STRING) || ' 000 '
            WHEN l_partkey % 23 = 0 THEN '-' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)
            WHEN l_partkey % 37 = 0 AND l_linenumber = 1 THEN '0'
            ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END AS val,
       l_linenumber * 1000000000000000000 + (l_partkey % 10000000000) * 100000000
         + CAST(round(l_extendedprice * 100, 0) AS BIGINT) % 100000000 AS pos
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fx_account": f"""
SELECT o_orderkey AS deposit_id, CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE {_num('o_custkey')} END AS num,
       CASE WHEN o_orderkey % 59 = 0 THEN '' WHEN o_orderkey % 61 = 0 THEN NULL ELSE {REFERENCE} END AS reference,
       CAST(substr({DAY}, 1, 4) AS INT) AS period_year,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 5 = 0 END AS migration,
       CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN '  ' ELSE
         '"Code","Value"' || chr(10) || '"Entity name","Firm ' || CAST(o_custkey AS STRING) || '"' || chr(10)
         || '"Accounting period end date","' || substr({DAY}, 1, 4) || '-12-31"' || chr(10)
         || CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE '"70","' || CAST({MONEY} AS STRING) || '"' || chr(10) END
         || '"60","' || CAST({MONEY} - 30000 - (o_orderkey % 100) * 500 AS STRING) || '"' || chr(10)
         || '"630","' || CAST((o_orderkey % 50) * 100 AS STRING) || '"' || chr(10)
         || '9901,' || CAST({MONEY} - 200000 AS STRING) || chr(10)
         || '9904,' || CAST({MONEY} - 210000 AS STRING) || chr(10)
         || CASE WHEN o_orderkey % 13 = 0 THEN '9904,' || CAST({MONEY} - 220000 AS STRING) || chr(10) ELSE '' END
         || '"54/58","' || CAST({MONEY} - 100 AS STRING) || '"' || chr(10)
         || '"10/15","' || CASE WHEN o_orderkey % 31 = 0 THEN '' ELSE CAST({MONEY} - 250000 AS STRING) END || '"' || chr(10)
         || '"20/58","' || CAST({MONEY} + 1000 AS STRING) || '"' || chr(10)
         || '"17","' || CASE WHEN o_orderkey % 19 = 0 THEN 'n/a' ELSE CAST((o_orderkey % 7) * 1000 AS STRING) END || '"' || chr(10)
         || '"43","' || CAST((o_orderkey % 11) * 10 AS STRING) || '"' || chr(10)
         || '"670/3","' || CAST((o_orderkey % 9) * 250 AS STRING) || '"' || chr(10) END AS raw_csv
FROM orders""",
    "fx_statute": f"""
SELECT o_orderkey AS document_id, {_num('o_custkey')} AS num,
       CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE {DAY} END AS deed_date,
       CASE WHEN o_orderstatus = 'P' THEN 'PENDING' ELSE 'DONE' END AS document_status,
       'Statuts ' || o_orderpriority AS document_title,
       'pdf-' || CAST(o_orderkey AS STRING) AS body
FROM orders""",
    "fx_document": f"""
SELECT CASE WHEN doc_id % 3 = 0 THEN 'nbb' WHEN doc_id % 3 = 1 THEN 'notaire' ELSE 'ejustice' END AS source,
       {_num('CAST(floor(doc_id / 4) AS BIGINT)')} AS enterprise, CASE WHEN doc_id % 71 = 0 THEN NULL ELSE CAST(2020 + doc_id % 6 AS STRING) END AS year,
       'f' || CAST(doc_id AS STRING) || CASE doc_id % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '.CSV' WHEN 2 THEN '.html' ELSE '' END AS filename,
       CASE doc_id % 6 WHEN 0 THEN '/documents/' WHEN 1 THEN '/kbopub/../' WHEN 2 THEN '/tmp/' WHEN 3 THEN 'documents/'
            WHEN 4 THEN '/' || {_num('CAST(floor(doc_id / 4) AS BIGINT)')} || '/hbb/' ELSE '/ejustice/' END
         || CAST(doc_id AS STRING) || CASE WHEN doc_id % 4 = 0 THEN '.csv' ELSE '' END AS path,
       CASE WHEN doc_id % 2 = 0 THEN NULL ELSE 'Titre ' || CAST(doc_id AS STRING) END AS title,
       CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'R' || CAST(doc_id AS STRING) END AS reference,
       n_chars AS size_bytes, text, doc_id
FROM documents""",
    "fx_target": f"""
SELECT {_num('c_custkey')} AS num,
       CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 <= 2 THEN 'error' WHEN c_custkey % 10 <= 5 THEN 'pending' ELSE 'done' END AS status,
       CASE WHEN c_custkey % 10 >= 6 THEN CAST(c_custkey % 4 AS INT) END AS filings_count,
       CASE WHEN c_custkey % 10 IN (1, 2) THEN 'failure on ' || c_name || ' ' || c_mktsegment
            || ' while the list of deposits was read from the archive, see the log of the run' END AS error,
       CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE CAST(1 + c_custkey % 5 AS INT) END AS updated_run,
       c_name AS denomination
FROM customer""",
    "fx_checkpoint": f"""
SELECT {_num('s_suppkey * 3')} AS num,
       CASE WHEN s_suppkey % 4 = 0 THEN NULL WHEN s_suppkey % 4 = 1 THEN 'error' ELSE 'done' END AS nbb,
       CASE WHEN s_suppkey % 3 = 0 THEN 'done' WHEN s_suppkey % 3 = 1 THEN 'empty' ELSE NULL END AS ejustice
FROM supplier""",
    "fx_card_page": f"""
SELECT {_num('c_custkey')} AS num, 1 AS page,
       '<html><body><h1>Fiche</h1><table><tr><td class="I" colspan="3">G&eacute;n&eacute;ralit&eacute;s</td></tr>'
       || '<tr><td class="QL">Num&eacute;ro d&#39;entreprise:</td><td class="QL">' || {_dotted('c_custkey')} || '</td></tr>'
       || '<tr><td class="QL">Statut:</td><td class="QL"><span> ' || CASE WHEN c_custkey % 10 = 0 THEN 'Arr&ecirc;t&eacute;' ELSE 'Actif' END || ' </span></td></tr>'
       || '<tr><td class="QL">D&eacute;nomination:</td><td class="QL">' || CASE WHEN c_custkey % 5 = 0 THEN 'Pas de donn&eacute;es' ELSE c_name END || '</td></tr>'
       || '<tr><td class="QL">D&eacute;nomination de la personne morale:</td><td class="QL">' || c_name || ' SA</td></tr>'
       || '<tr><td class="QL">Adresse:</td><td class="QL">Rue ' || CAST(c_nationkey AS STRING) || '</td></tr>'
       || '<tr><td class="QL">Adresse:</td><td class="QL">Rue ' || CAST(c_nationkey AS STRING) || ', bte   ' || CAST(c_custkey % 90 AS STRING) || '</td></tr>'
       || '<tr><td class="QL">Capital:</td><td>' || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) || '</td><td>EUR</td></tr>'
       || '<tr><td class="QL">Nombre d&#39;unit&eacute;s d&#39;&eacute;tablissement (UE):</td><td class="QL"><b>' || CAST(c_custkey % 12 AS STRING)
       || '</b> UE <a href="toonvestigingps.html?ondernemingsnummer=' || CAST(c_custkey AS STRING) || '">liste</a></td></tr>'
       || '<tr><td class="I">' || CASE WHEN c_custkey % 2 = 0 THEN 'Fonctions' ELSE 'Functies' END || '</td></tr>'
       || '<tr><td>Administrateur</td><td>' || {_dotted('c_nationkey * 3')} || '</td><td>Depuis le 1 mai 2020</td></tr>'
       || '<tr><td>G&eacute;rant</td><td>Dupont , ' || c_mktsegment || '</td></tr>'
       || '<tr><td>Depuis le 3 mai</td><td>x</td></tr>'
       || '<tr><td>Secr&eacute;taire</td><td></td></tr>'
       || '<tr><td class="I">Liens entre entit&eacute;s</td></tr>'
       || CASE WHEN c_custkey % 3 = 0 THEN '<tr><td>Pas de donn&eacute;es</td></tr>'
               ELSE '<tr><td>' || {_dotted('c_nationkey')} || ' (ACME ' || c_mktsegment || ')</td><td>est absorb&eacute;</td></tr>' END
       || '<tr><td class="I">Activit&eacute;s</td></tr>'
       || '<tr><td><a href="naceToelichting.html?nace.version=2008' || CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '&amp;nace.code=' || CAST(70000 + c_custkey % 900 AS STRING) END
       || '">' || CAST(70000 + c_custkey % 900 AS STRING) || '</a> Activit&eacute; ' || c_mktsegment || '</td></tr>'
       || '</table><a href="http://a.example/ejustice/1">1</a><a href="http://consult.cbso.nbb.be/' || CAST(c_custkey AS STRING) || '">n</a>'
       || '<a href="http://a.example/ejustice/' || CAST(c_custkey AS STRING) || '">2</a>'
       || CASE WHEN c_custkey % 6 = 0 THEN '<a href="http://statuts.notaire.be/' || CAST(c_custkey AS STRING) || '">s</a>' ELSE '' END
       || '</body></html>' AS html
FROM customer""",
    "fx_pub_page": f"""
SELECT {_num('o_custkey')} AS num, o_orderkey AS page,
       '<html><body><ul><li>Acte ' || o_orderpriority || '  no ' || CAST(o_orderkey AS STRING) || ' <a href="/tsv_pdf/' || replace({DAY}, '-', '/') || '/P' || CAST(o_orderkey AS STRING)
       || '.pdf">image</a></li><li>Copie <a href="/tsv_pdf/' || replace({DAY}, '-', '/') || '/P' || CAST(o_orderkey AS STRING) || '.pdf">image</a></li></ul>'
       || '<div>Avis du ' || {DAY} || ' <a href="https://pub.example/tsv_pdf/2020/01/02/N' || CAST(o_orderkey % 5 AS STRING) || '.pdf">avis</a></div>'
       || '<p><a href="list.html?page=' || CAST(1 + o_orderkey % 80 AS STRING) || '">next</a> <a href="/about">about</a></p></body></html>' AS html
FROM orders""",
    "fx_web_page": """
SELECT 'w' || CAST(page_id AS STRING) AS num, 1 AS page, url, html FROM pages""",
}

#: Keys by which views are landed where that is not ``num``; codes have none.
KEYS: dict[str, str | None] = {"fx_document": "enterprise", "fx_code": None}

_EACH = re.compile(r"@each\((\w+): ([^)]*)\)")


def spark_text(name: str) -> str:
    text = VIEWS[name].replace("@row(", "struct(")
    text = _EACH.sub(r"LATERAL VIEW explode(array(\2)) each_\1 AS \1", text)
    return re.sub(rf"\b(FROM|JOIN) ({'|'.join(TABLES)})\b", r"\1 {\2}", text)


def duckdb_text(name: str) -> str:
    text = VIEWS[name].replace("@row(", "row(")
    return _EACH.sub(r"CROSS JOIN unnest([\2]) AS each_\1(\1)", text)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A derived register table as a DataFrame."""
    text = spark_text(name)
    used = set(re.findall(r"\{(\w+)\}", text))
    return spark.sql(text, **{t: table(spark, sf, t) for t in used})


_LANDED: dict[tuple[str, str, str], Landed] = {}
_SIZES: dict[tuple[str, str], int] = {}


def landed(spark: SparkSession, sf: str, name: str, make: Callable[[], DataFrame] | None = None, key: str | None = "num") -> Landed:
    """The table landed under ``name`` for this data folder, written on its first use in a session; a view unless ``make`` gives its rows."""
    app = spark.sparkContext.applicationId
    if (app, sf) not in _SIZES:
        _SIZES[app, sf] = source_bytes(spark, sf)
    if (app, sf, name) not in _LANDED:
        buckets = bucket_number(_SIZES[app, sf])
        rows, by = (make(), key) if make else (view(spark, sf, name), KEYS.get(name, "num"))
        _LANDED[app, sf, name] = land(rows, name, by, buckets, min(TASK_BYTES, max(1 << 20, 2 * _SIZES[app, sf] // buckets)))
    return _LANDED[app, sf, name]


def forget(spark: SparkSession) -> None:
    """Drop the landed tables and all other intermediates of this application; later queries land anew."""
    app = spark.sparkContext.applicationId
    for key in [k for k in _LANDED if k[0] == app]:
        spark.sql(f"DROP TABLE IF EXISTS {_LANDED.pop(key).name}")
    drop_intermediates(spark)


def with_views(sql: str) -> str:
    """Checking SQL with the views it mentions put in front as CTEs."""
    names = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    if not names:
        return sql
    ctes = ",\n".join(f"{n} AS ({duckdb_text(n)})" for n in names)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
