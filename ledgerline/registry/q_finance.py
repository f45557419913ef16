"""Finance queries (FIN, and the aggregates and windows behind them)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ledgerline.functions.dates import fiscal_year
from ledgerline.functions.numbers import parse_amount, percent, ratio, sum_or_first, zero_if_null
from ledgerline.operators import picks
from ledgerline.plans import finance as fin
from ledgerline.registry.book import query
from ledgerline.registry.sqltext import ACCOUNT_CODES, FILINGS, amount
from ledgerline.session import new_folder
from ledgerline.sources import archive

METRIC_COLS = fin.METRICS + fin.RATIOS
ALL_METRICS = ", ".join(f"round({c}, 2) AS {c}" for c in fin.METRICS) + ", " + ", ".join(fin.RATIOS)


def rounded(df, *keys):
    return df.select(*keys, *[F.round(c, 2).alias(c) for c in fin.METRICS], *fin.RATIOS)


@query("win01_growth", f"WITH {FILINGS} SELECT num, year, round(ca, 2) AS ca, croissance_ca FROM growth")
def win01(d):
    y = fin.yearly_metrics(d.fx_filing_line)
    return y.select("num", "year", F.round("ca", 2).alias("ca"), "croissance_ca")


FLAGSHIP_SQL = f"""WITH {FILINGS}
SELECT num, year, reference, round(ca, 2) AS ca, marge_nette, croissance_ca FROM growth"""


@query("fin00_revenue_margin_growth", FLAGSHIP_SQL)
def flagship(d):
    y = fin.yearly_metrics(d.fx_filing_line)
    return y.select("num", "year", "reference", F.round("ca", 2).alias("ca"), "marge_nette", "croissance_ca")


@query("fin02_filing_metrics", f"WITH {FILINGS} SELECT num, year, reference, fonds_propres_negatifs, {ALL_METRICS} FROM metrics")
def fin02(d):
    f = fin.one_filing_per_year(fin.filing_amounts(fin.usable_lines(d.fx_filing_line)))
    return rounded(fin.with_metrics(f), "num", "year", "reference", "fonds_propres_negatifs")


FIN01_COLS = """entity, period_end, round("70", 2) AS chiffre_affaires, round("70" - "60", 2) AS marge_brute,
  round("9901" + "630", 2) AS ebitda, round("9901", 2) AS ebit, round("9904", 2) AS resultat_net,
  round(("70" - "60") / nullif("70", 0) * 100, 2) AS taux_marge_brute, round(("9901" + "630") / nullif("70", 0) * 100, 2) AS taux_ebitda,
  round("9904" / nullif("70", 0) * 100, 2) AS marge_nette, round("54/58", 2) AS tresorerie, round("17" + "43", 2) AS dettes_fin,
  round("17" + "43" - "54/58", 2) AS dette_nette, round("10/15", 2) AS fonds_propres, round("20/58", 2) AS total_actif,
  round("10/15" / nullif("20/58", 0) * 100, 2) AS autonomie_fin"""
EURO = ["chiffre_affaires", "marge_brute", "ebitda", "ebit", "resultat_net", "tresorerie", "dettes_fin", "dette_nette", "fonds_propres", "total_actif"]


def euro_rounded(df):
    return df.withColumns({c: F.round(c, 2) for c in EURO})


@query("fin01_filing_kpis", f"WITH {ACCOUNT_CODES} SELECT deposit_id, num, {FIN01_COLS} FROM codes")
def fin01(d):
    return euro_rounded(fin.filing_kpis(d.fx_account)).drop("period_year", "reference")


@query("fin03_kpi_table", f"WITH {ACCOUNT_CODES} SELECT deposit_id, num, period_year, reference, {FIN01_COLS} FROM codes")
def fin03(d):
    return euro_rounded(fin.filing_kpis(d.fx_account))


def hotel_targets(d):
    return d.fx_target.select("num", "denomination", F.substring("denomination", 1, 4).alias("nace_codes"))


@query("fin04_gold", f"""WITH {FILINGS},
kind AS (SELECT num, CASE WHEN bool_or(ca IS NOT NULL) THEN 'full' WHEN bool_or(fonds_propres IS NOT NULL) THEN 'abrege' ELSE 'micro' END AS schema_type,
  count(*) AS nb_exercices FROM growth GROUP BY num)
SELECT g.num, t.denomination, substr(t.denomination, 1, 4) AS nace_codes, schema_type, CAST(nb_exercices AS INT) AS nb_exercices, year, reference, fonds_propres_negatifs, croissance_ca, {ALL_METRICS}
FROM growth g JOIN fx_target t ON g.num = t.num JOIN kind k ON k.num = g.num""")
def fin04(d):
    targets = hotel_targets(d)
    g = fin.gold(fin.yearly_metrics(d.fx_filing_line, targets), targets)
    flat = g.select("num", "denomination", "nace_codes", "schema_type", "nb_exercices", F.explode("years").alias("y"))
    flat = flat.select("num", "denomination", "nace_codes", "schema_type", "nb_exercices", "y.*").select("*", "ratios.*").drop("ratios")
    return rounded(flat, "num", "denomination", "nace_codes", "schema_type", "nb_exercices", "year", "reference", "fonds_propres_negatifs", "croissance_ca")


STORED_LINES = """stored_line AS (SELECT num, reference, pos, trim(replace(split_part(line, ',', 1), '"', '')) AS code, trim(replace(split_part(line, ',', 2), '"', '')) AS val
FROM (SELECT num, reference, i AS pos, string_split(raw_csv, chr(10))[i] AS line FROM fx_account, unnest(generate_series(1, len(string_split(raw_csv, chr(10))))) AS t(i)
WHERE coalesce(num, '') <> '' AND coalesce(reference, '') <> '') WHERE line LIKE '%,%')"""

#: Amounts over a few round divisors give many ties, so the checking SQL rounds the printed decimal half-up, as Spark does.
STORED_FILINGS = re.sub(r"round\((.+?), 4\)", r"CAST(round(CAST(CAST(\1 AS VARCHAR) AS DECIMAL(30,15)), 4) AS DOUBLE)", FILINGS.replace("fx_filing_line", "stored_line"))


@query("fin04b_gold_from_accounts", f"""WITH {STORED_LINES}, {STORED_FILINGS}
SELECT g.num, t.denomination, year, reference, fonds_propres_negatifs, croissance_ca, {ALL_METRICS} FROM growth g JOIN fx_target t ON g.num = t.num""")
def fin04b(d):
    """The archive of filings is not there, so the texts stored with the accounts are used."""
    nowhere = new_folder(d.spark, "absent")
    lines = archive.first_filled(lambda: archive.text_lines(d.spark, nowhere), lambda: archive.account_lines(d.fx_account))
    targets = hotel_targets(d)
    g = fin.gold(fin.yearly_metrics(archive.filing_lines(lines), targets), targets)
    flat = g.select("num", "denomination", F.explode("years").alias("y")).select("num", "denomination", "y.*").select("*", "ratios.*").drop("ratios")
    return rounded(flat, "num", "denomination", "year", "reference", "fonds_propres_negatifs", "croissance_ca")


FLOW = f"""{FILINGS},
sides AS (SELECT *, coalesce(resultat_net < 0, false) AS deficit, coalesce(resultat_net < 0, false) AND coalesce(ca > 0, false) AS at_loss FROM growth),
edges AS (
  SELECT num, year, deficit, at_loss, 1 AS k, 'Chiffre d''affaires' AS source, 'Charges' AS target, ca AS value FROM sides WHERE at_loss
  UNION ALL SELECT num, year, deficit, at_loss, 2, 'Perte de l''exercice', 'Charges', -resultat_net FROM sides WHERE at_loss
  UNION ALL SELECT num, year, deficit, at_loss, 1, 'Chiffre d''affaires', 'Charges exploit.', ca - ebit FROM sides WHERE NOT at_loss
  UNION ALL SELECT num, year, deficit, at_loss, 2, 'Chiffre d''affaires', 'Résultat exploit.', ebit FROM sides WHERE NOT at_loss
  UNION ALL SELECT num, year, deficit, at_loss, 3, 'Résultat exploit.', 'Résultat avant impôts', resultat_avant_impots FROM sides WHERE NOT at_loss
  UNION ALL SELECT num, year, deficit, at_loss, 4, 'Résultat avant impôts', 'Résultat net', resultat_net FROM sides WHERE NOT at_loss
  UNION ALL SELECT num, year, deficit, at_loss, 5, 'Résultat avant impôts', 'Impôts', impots FROM sides WHERE NOT at_loss),
kept AS (SELECT *, row_number() OVER (PARTITION BY num, year ORDER BY k) - 1 AS link_no FROM edges WHERE value > 0),
names AS (SELECT * FROM (VALUES (true, 0, 'Chiffre d''affaires'), (true, 1, 'Perte de l''exercice'), (true, 2, 'Charges'), (false, 0, 'Chiffre d''affaires'),
  (false, 1, 'Charges exploit.'), (false, 2, 'Résultat exploit.'), (false, 3, 'Résultat avant impôts'), (false, 4, 'Résultat net'), (false, 5, 'Impôts')) AS v(at_loss, o, name)),
used AS (SELECT DISTINCT num, year, at_loss, source AS name FROM kept UNION SELECT DISTINCT num, year, at_loss, target FROM kept),
nodes AS (SELECT u.num, u.year, u.name, row_number() OVER (PARTITION BY u.num, u.year ORDER BY o) - 1 AS node_index FROM used u JOIN names n ON n.at_loss = u.at_loss AND n.name = u.name)
"""


@query("fin05_flow_edges", f"WITH {FLOW} SELECT num, year, deficit, source, target, round(value, 2) AS value FROM kept")
def fin05(d):
    links = fin.flow_links(fin.flow_graph(fin.yearly_metrics(d.fx_filing_line)))
    return links.select("num", "year", "deficit", "source", "target", "value")


@query("fin06_flow_nodes", f"""WITH {FLOW}
SELECT k.num, k.year, CAST(link_no AS INT) AS link_no, source, target, CAST(a.node_index AS INT) AS source_index, CAST(b.node_index AS INT) AS target_index
FROM kept k JOIN nodes a ON a.num = k.num AND a.year = k.year AND a.name = k.source
JOIN nodes b ON b.num = k.num AND b.year = k.year AND b.name = k.target""")
def fin06(d):
    links = fin.flow_links(fin.flow_graph(fin.yearly_metrics(d.fx_filing_line)))
    return links.select("num", "year", "link_no", "source", "target", "source_index", "target_index")


@query("fin06b_node_list", f"WITH {FLOW} SELECT num, year, CAST(node_index AS INT) AS node_index, name FROM nodes")
def fin06b(d):
    return fin.flow_nodes(fin.flow_graph(fin.yearly_metrics(d.fx_filing_line)))


@query("fin07_detailed_flow", f"""WITH {ACCOUNT_CODES},
v AS (SELECT deposit_id, num, "70" AS ca, "60" AS cogs, "70" - "60" AS gp, "9901" AS ebit, greatest("70" - "60" - "9901", 0) AS opex,
  "670/3" AS tax, "9904" AS net, "9904" + "670/3" AS ebt, "60" > "70" * 0.01 AS goods FROM codes),
e AS (SELECT deposit_id, num, unnest(CASE WHEN goods THEN [
  {{s: 'Chiffre d''affaires', t: 'Marge brute', v: gp}}, {{s: 'Chiffre d''affaires', t: 'Coût des ventes', v: cogs}},
  {{s: 'Marge brute', t: 'Résultat exploit.', v: ebit}}, {{s: 'Marge brute', t: 'Charges exploit.', v: opex}},
  {{s: 'Résultat exploit.', t: 'Résultat avant impôts', v: ebt}}, {{s: 'Résultat avant impôts', t: 'Résultat net', v: net}},
  {{s: 'Résultat avant impôts', t: 'Impôts', v: tax}}] ELSE [
  {{s: 'Chiffre d''affaires', t: 'Résultat exploit.', v: ebit}}, {{s: 'Chiffre d''affaires', t: 'Charges exploit.', v: opex}},
  {{s: 'Résultat exploit.', t: 'Résultat avant impôts', v: ebt}}, {{s: 'Résultat avant impôts', t: 'Résultat net', v: net}},
  {{s: 'Résultat avant impôts', t: 'Impôts', v: tax}}] END) AS x FROM v)
SELECT deposit_id, num, x.s AS source, x.t AS target, round(x.v, 2) AS value FROM e""")
def fin07(d):
    keys = ["deposit_id", "num"]
    return fin.detailed_flow(fin.code_table(fin.eligible(d.fx_account), keys), keys).drop("link_no")


FFILL = """last_value(nullif({c}, 0) IGNORE NULLS) OVER (PARTITION BY num ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@query("win05_forward_fill", f"""WITH {FILINGS} SELECT num, year, round({FFILL.format(c='ca')}, 2) AS ca,
  round({FFILL.format(c='resultat_net')}, 2) AS resultat_net FROM growth""")
def win05(d):
    y = fin.with_metrics(fin.one_filing_per_year(fin.filing_amounts(fin.usable_lines(d.fx_filing_line))))
    filled = picks.fill_forward(y, ["ca", "resultat_net"])
    return filled.select("num", "year", F.round("ca", 2).alias("ca"), F.round("resultat_net", 2).alias("resultat_net"))


@query("fin08_year_series", f"""WITH {FILINGS}, f AS (SELECT num, year, {FFILL.format(c='ca')} AS ca, {FFILL.format(c='resultat_net')} AS resultat_net FROM growth)
SELECT num, year, 'ca' AS indicator, round(ca, 2) AS value FROM f UNION ALL SELECT num, year, 'resultat_net', round(resultat_net, 2) FROM f""")
def fin08(d):
    y = fin.with_metrics(fin.one_filing_per_year(fin.filing_amounts(fin.usable_lines(d.fx_filing_line))))
    long = fin.unpivot_metrics(picks.fill_forward(y, ["ca", "resultat_net"]), ["ca", "resultat_net"])
    return long.withColumn("value", F.round("value", 2))


REPORT = ["ca", "marge_brute", "ebit", "resultat_net", "fonds_propres", "croissance_ca", "marge_nette"]
REPORT_SQL = f"""WITH {FILINGS}, long AS ({' UNION ALL '.join(f"SELECT num, year, '{m}' AS indicator, {m} AS value FROM growth" for m in REPORT)})
SELECT num, indicator, year, round(value, 4) AS value FROM long"""


def report(d):
    long = fin.unpivot_metrics(fin.yearly_metrics(d.fx_filing_line), REPORT)
    return long.select("num", "indicator", "year", F.round("value", 4).alias("value"))


query("prj10_year_indicator", REPORT_SQL)(report)


@query("fin09_growth_report", f"""WITH {FILINGS} SELECT num, year, round(ca, 2) AS ca, round(marge_brute, 2) AS marge_brute,
  round(marge_brute / nullif(ca, 0) * 100, 4) AS taux_marge_brute, round(croissance_ca * 100, 2) AS croissance_pct FROM growth""")
def fin09(d):
    y = fin.yearly_metrics(d.fx_filing_line)
    return y.select(
        "num", "year", F.round("ca", 2).alias("ca"), F.round("marge_brute", 2).alias("marge_brute"),
        ratio(F.col("marge_brute"), F.col("ca"), 100).alias("taux_marge_brute"),
        F.round(F.col("croissance_ca") * 100, 2).alias("croissance_pct"),
    )


# --- pieces -------------------------------------------------------------------


@query("prj08_wide_codes", f"""WITH {FILINGS} SELECT num, reference, {', '.join(f'round("{c}", 2) AS c{i}' for i, c in enumerate(["70", "60", "9901", "9904", "10/15", "54/58"]))},
  CASE WHEN period_end IS NOT NULL THEN coalesce(TRY_CAST(regexp_extract(period_end, '(19|20)\\d{{2}}') AS DOUBLE), 0) END AS period_end FROM filings""")
def prj08(d):
    f = fin.filing_amounts(fin.usable_lines(d.fx_filing_line))
    wide = [F.round(F.col(f"`{c}`"), 2).alias(f"c{i}") for i, c in enumerate(["70", "60", "9901", "9904", "10/15", "54/58"])]
    return f.select("num", "reference", *wide, F.col(f"`{fin.PERIOD_END}`").alias("period_end"))


@query("win14_last_code_value", "SELECT num, reference, code, arg_max(val, pos) AS val FROM fx_filing_line GROUP BY num, reference, code")
def win14(d):
    return fin.last_code_values(d.fx_filing_line)


@query("win11_filing_per_year", f"WITH {FILINGS} SELECT num, year, reference FROM peryear")
def win11(d):
    return fin.one_filing_per_year(fin.filing_amounts(fin.usable_lines(d.fx_filing_line))).select("num", "year", "reference")


@query("flt02_needed_codes", f"WITH {FILINGS} SELECT num, reference, code, val FROM parsed")
def flt02(d):
    return fin.usable_lines(d.fx_filing_line).select("num", "reference", "code", "val")


@query("jn01_target_facts", """SELECT l.num, code, count(*) AS lines FROM fx_filing_line l JOIN fx_target t ON l.num = t.num AND t.status = 'pending'
GROUP BY l.num, code""")
def jn01(d):
    kept = fin.of_targets(d.fx_filing_line, d.fx_target.where("status = 'pending'"))
    return kept.groupBy("num", "code").agg(F.count("*").alias("lines"))


@query("jn15_gold_target_meta", f"""WITH {FILINGS}, n AS (SELECT num, count(*) AS n FROM growth GROUP BY num)
SELECT n.num, CAST(n AS INT) AS nb_exercices, t.denomination, substr(t.denomination, 1, 4) AS nace_codes FROM n LEFT JOIN fx_target t ON n.num = t.num""")
def jn15(d):
    return fin.gold(fin.yearly_metrics(d.fx_filing_line), hotel_targets(d)).select("num", "nb_exercices", "denomination", "nace_codes")


@query("agg16_exercises", f"WITH {FILINGS} SELECT num, CAST(count(*) AS INT) AS nb_exercices, string_agg(year, ',' ORDER BY year) AS annees FROM growth GROUP BY num")
def agg16(d):
    g = fin.gold(fin.yearly_metrics(d.fx_filing_line), hotel_targets(d))
    return g.select("num", "nb_exercices", F.array_join(F.transform("years", lambda y: y["year"]), ",").alias("annees"))


@query("agg17_schema_type", f"""WITH {FILINGS} SELECT num, CASE WHEN bool_or(ca IS NOT NULL) THEN 'full'
  WHEN bool_or(fonds_propres IS NOT NULL) THEN 'abrege' ELSE 'micro' END AS schema_type FROM growth GROUP BY num""")
def agg17(d):
    y = fin.with_metrics(fin.one_filing_per_year(fin.filing_amounts(fin.usable_lines(d.fx_filing_line))))
    return y.groupBy("num").agg(fin.schema_type(F.col("ca"), F.col("fonds_propres")).alias("schema_type"))


@query("agg18_with_revenue", f"""WITH {FILINGS}, e AS (SELECT num, bool_and(ca IS NOT NULL) AS every, bool_or(ca IS NOT NULL) AS any_one FROM growth GROUP BY num)
SELECT count(*) AS enterprises, count(*) FILTER (every) AS every_year, count(*) FILTER (any_one) AS some_year FROM e""")
def agg18(d):
    g = fin.gold(fin.yearly_metrics(d.fx_filing_line), hotel_targets(d))
    every = F.forall("years", lambda y: y["ca"].isNotNull())
    some = F.exists("years", lambda y: y["ca"].isNotNull())
    return g.agg(F.count("*").alias("enterprises"), F.count_if(every).alias("every_year"), F.count_if(some).alias("some_year"))


COVER = {**{k: v for k, v in fin.METRIC_CODES.items()}, **{k: a + b for k, (a, b) in fin.SUMMED_CODES.items()}}


@query("agg10_code_coverage", f"""WITH s AS (SELECT DISTINCT num, reference FROM fx_filing_line),
f AS (SELECT code, count(DISTINCT (s.num, s.reference)) AS n FROM fx_filing_line l JOIN s ON l.num = s.num AND l.reference = s.reference GROUP BY code),
t AS (SELECT count(*) AS n FROM s)
{' UNION ALL '.join(f"SELECT '{m}' AS metric, coalesce((SELECT max(n) FROM f WHERE code IN ({', '.join(repr(c) for c in v)})), 0) AS best, t.n, round(coalesce((SELECT max(n) FROM f WHERE code IN ({', '.join(repr(c) for c in v)})), 0) * 100 / t.n, 1) AS share FROM t" for m, v in COVER.items())}""")
def agg10(d):
    return fin.code_coverage(d.fx_filing_line)


@query("agg10b_code_frequency", """WITH s AS (SELECT DISTINCT num, reference FROM fx_filing_line)
SELECT code, count(DISTINCT (s.num, s.reference)) AS count FROM fx_filing_line l JOIN s ON l.num = s.num AND l.reference = s.reference GROUP BY code""")
def agg10b(d):
    return fin.code_frequency(d.fx_filing_line)


@query("win02_latest_year", f"WITH {FILINGS} SELECT num, max(year) AS year, round(arg_max(coalesce(ca, -1), year), 2) AS ca FROM growth GROUP BY num")
def win02(d):
    y = fin.latest_year(fin.yearly_metrics(d.fx_filing_line))
    return y.select("num", "year", F.round(F.coalesce("ca", F.lit(-1.0)), 2).alias("ca"))


@query("win03_chosen_year", f"""WITH {FILINGS} SELECT num, year, reference FROM growth
QUALIFY row_number() OVER (PARTITION BY num ORDER BY (year = '1997') DESC, year DESC) = 1""")
def win03(d):
    return fin.chosen_year(fin.yearly_metrics(d.fx_filing_line), "1997").select("num", "year", "reference")


@query("srt01_year_summary", f"WITH {FILINGS} SELECT num, year, round(ca, 2) AS ca, round(resultat_net, 2) AS resultat_net, marge_nette FROM growth ORDER BY year DESC, num")
def srt01(d):
    y = fin.yearly_metrics(d.fx_filing_line).orderBy(F.desc("year"), "num")
    return y.select("num", "year", F.round("ca", 2).alias("ca"), F.round("resultat_net", 2).alias("resultat_net"), "marge_nette")


@query("str03_parse_amount", f"SELECT num, reference, code, val, round({amount('val')}, 4) AS amount FROM fx_filing_line")
def str03(d):
    return d.fx_filing_line.select("num", "reference", "code", "val", F.round(parse_amount(F.col("val")), 4).alias("amount"))


@query("str04_first_variant", f"""WITH {FILINGS} SELECT num, reference, round(coalesce("9901", "9900"), 2) AS ebit,
  round("100", 2) AS capital FROM filings""")
def str04(d):
    f = fin.filing_amounts(fin.usable_lines(d.fx_filing_line))
    ebit = fin.first_amount([F.col("`9901`"), F.col("`9900`")])
    capital = fin.first_amount([F.col("`100`"), F.col("`10`")])
    return f.select("num", "reference", F.round(ebit, 2).alias("ebit"), F.round(capital, 2).alias("capital"))


@query("str07_fiscal_year", """SELECT num, reference, pos, CASE WHEN code LIKE 'Accounting%' AND regexp_matches(val, '(19|20)\\d{2}') THEN regexp_extract(val, '(19|20)\\d{2}')
  WHEN regexp_full_match(split_part(reference, '-', 1), '(19|20)\\d{2}') THEN split_part(reference, '-', 1) ELSE '?' END AS year FROM fx_filing_line""")
def str07(d):
    end = F.when(F.col("code") == fin.PERIOD_END, F.col("val"))
    return d.fx_filing_line.select("num", "reference", "pos", fiscal_year(end, F.col("reference")).alias("year"))


@query("mth01_ratio", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice / nullif(l_discount, 0) * 100, 4) AS ratio FROM lineitem")
def mth01(d):
    r = ratio(F.col("l_extendedprice"), F.col("l_discount"), 100)
    return d.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r.alias("ratio"))


@query("mth02_percent", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity / nullif(l_tax, 0) * 100, 2) AS pct FROM lineitem")
def mth02(d):
    p = percent(F.col("l_quantity"), F.col("l_tax"))
    return d.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", p.alias("pct"))


@query("mth03_summed_codes", f"""WITH {FILINGS} SELECT num, reference,
  round(CASE WHEN coalesce("54", "55") IS NOT NULL THEN coalesce("54", 0) + coalesce("55", 0) ELSE coalesce("54/58", "50/53") END, 2) AS tresorerie,
  round(CASE WHEN coalesce("17", "43") IS NOT NULL THEN coalesce("17", 0) + coalesce("43", 0) ELSE "42/48" END, 2) AS dettes FROM filings""")
def mth03(d):
    f = fin.filing_amounts(fin.usable_lines(d.fx_filing_line))
    c = {k: F.col(f"`{k}`") for k in ("54", "55", "54/58", "50/53", "17", "43", "42/48")}
    cash = sum_or_first([c["54"], c["55"]], [c["54/58"], c["50/53"]])
    debt = sum_or_first([c["17"], c["43"]], [c["42/48"]])
    return f.select("num", "reference", F.round(cash, 2).alias("tresorerie"), F.round(debt, 2).alias("dettes"))


@query("mth04_null_arithmetic", f"""WITH {FILINGS} SELECT num, reference, round("70" - coalesce("60", 0) + coalesce("71", 0), 2) AS marge_brute,
  round("70" - coalesce("9901", "9900"), 2) AS charges FROM filings""")
def mth04(d):
    f = fin.filing_amounts(fin.usable_lines(d.fx_filing_line))
    gross = F.col("`70`") - zero_if_null(F.col("`60`")) + zero_if_null(F.col("`71`"))
    charges = F.col("`70`") - F.coalesce(F.col("`9901`"), F.col("`9900`"))
    return f.select("num", "reference", F.round(gross, 2).alias("marge_brute"), F.round(charges, 2).alias("charges"))


@query("src17_csv_codes", f"WITH {ACCOUNT_CODES} SELECT deposit_id, CAST(line_no - 1 AS INT) AS line_no, code, val, amount FROM amounts")
def src17(d):
    return fin.csv_codes(fin.eligible(d.fx_account), ["deposit_id"])


@query("flt13_csv_eligible", "SELECT deposit_id FROM fx_account WHERE NOT coalesce(migration, false) AND trim(raw_csv) <> ''")
def flt13(d):
    return fin.eligible(d.fx_account).select("deposit_id")
