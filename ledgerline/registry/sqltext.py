"""Fragments of checking SQL (DuckDB) shared by several queries."""

from __future__ import annotations

from ledgerline.constants import METRIC_CODES, PERIOD_END, SUMMED_CODES
from ledgerline.plans.finance import filing_columns


def amount(x: str) -> str:
    """Locale number parse, stated independently of the DataFrame version."""
    packed = f"replace(replace(trim({x}), ' ', ''), chr(160), '')"
    bare = f"trim(ltrim({packed}, '-'), '()')"
    plain = (
        f"CASE WHEN contains({bare}, '.') AND contains({bare}, ',') THEN replace(replace({bare}, '.', ''), ',', '.') "
        f"ELSE replace({bare}, ',', '.') END"
    )
    sign = f"CASE WHEN {packed} LIKE '-%' OR ({packed} LIKE '(%' AND {packed} LIKE '%)') THEN -1 ELSE 1 END"
    number = f"CASE WHEN regexp_full_match({plain}, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') THEN TRY_CAST({plain} AS DOUBLE) END"
    return f"({number}) * ({sign})"


def coalesce(cols: list[str]) -> str:
    return f"coalesce({', '.join(cols)})" if len(cols) > 1 else cols[0]


def col(code: str) -> str:
    return f'"{code}"'


NEEDED = ", ".join(f"'{c}'" for c in filing_columns())

FILINGS = f"""
parsed AS (SELECT num, reference, code, val, pos, {amount('val')} AS amount FROM fx_filing_line WHERE code IN ({NEEDED}) AND val <> ''),
lastval AS (SELECT * FROM parsed QUALIFY row_number() OVER (PARTITION BY num, reference, code ORDER BY pos DESC) = 1),
filings AS (SELECT num, reference, {', '.join(f"max(amount) FILTER (code = '{c}') AS {col(c)}" for c in filing_columns() if c != PERIOD_END)},
            max(val) FILTER (code = '{PERIOD_END}') AS period_end FROM lastval GROUP BY num, reference),
dated AS (SELECT *, CASE WHEN regexp_matches(coalesce(period_end, ''), '(19|20)\\d{{2}}') THEN regexp_extract(period_end, '(19|20)\\d{{2}}')
            WHEN regexp_full_match(split_part(reference, '-', 1), '(19|20)\\d{{2}}') THEN split_part(reference, '-', 1) ELSE '?' END AS year FROM filings),
peryear AS (SELECT * FROM dated QUALIFY row_number() OVER (PARTITION BY num, year ORDER BY reference DESC) = 1),
base AS (SELECT num, year, reference,
  {', '.join(f"{coalesce([col(c) for c in codes])} AS {m}" for m, codes in METRIC_CODES.items())},
  {', '.join(
      f"CASE WHEN {coalesce([col(c) for c in parts])} IS NOT NULL THEN {' + '.join(f'coalesce({col(c)}, 0)' for c in parts)} "
      f"ELSE {coalesce([col(c) for c in totals])} END AS {m}" for m, (parts, totals) in SUMMED_CODES.items())}
  FROM peryear),
metrics AS (SELECT *, ca - coalesce(achats, 0) + coalesce(variation_stocks, 0) AS marge_brute, ca - ebit AS charges_exploitation,
  resultat_avant_impots - resultat_net AS impots, coalesce(fonds_propres <= 0, false) AS fonds_propres_negatifs,
  round(resultat_net / nullif(ca, 0) * 100, 4) AS marge_nette,
  CASE WHEN fonds_propres > 0 THEN round(resultat_net / fonds_propres * 100, 4) END AS roe,
  round(tresorerie / nullif(dettes_financieres, 0), 4) AS ratio_liquidite,
  CASE WHEN fonds_propres > 0 THEN round(dettes_financieres / fonds_propres * 100, 4) END AS taux_endettement FROM base),
growth AS (SELECT m.*, round((ca - prev) / nullif(prev, 0), 4) AS croissance_ca FROM (SELECT *,
  last_value(ca IGNORE NULLS) OVER (PARTITION BY num ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM metrics) m)
"""

ACCOUNT_CODES = """
lines AS (SELECT deposit_id, num, period_year, reference, i AS line_no, string_split(raw_csv, chr(10))[i] AS line
  FROM fx_account, unnest(generate_series(2, len(string_split(raw_csv, chr(10))))) AS t(i)
  WHERE NOT coalesce(migration, false) AND trim(raw_csv) <> ''),
cells AS (SELECT deposit_id, num, period_year, reference, line_no, trim(replace(split_part(line, ',', 1), '"', '')) AS code,
  nullif(replace(split_part(line, ',', 2), '"', ''), '') AS val FROM lines WHERE trim(line) <> ''),
amounts AS (SELECT *, TRY_CAST(val AS DOUBLE) AS amount FROM cells),
lastcode AS (SELECT * FROM amounts QUALIFY row_number() OVER (PARTITION BY deposit_id, code ORDER BY line_no DESC) = 1),
codes AS (SELECT deposit_id, num, period_year, reference,
  {sums}, max(val) FILTER (code = 'Entity name') AS entity, max(val) FILTER (code = 'Accounting period end date') AS period_end
  FROM lastcode GROUP BY ALL HAVING count(*) FILTER (code IN ({used}) AND val IS NOT NULL AND amount IS NULL) = 0)
""".replace(
    "{sums}",
    ", ".join(
        f"coalesce(max(amount) FILTER (code = '{c}'), 0) AS {col(c)}"
        for c in ["70", "60", "630", "9901", "9904", "54/58", "10/15", "20/58", "17", "43", "670/3"]
    ),
).replace("{used}", ", ".join(f"'{c}'" for c in ["70", "60", "630", "9901", "9904", "54/58", "10/15", "20/58", "17", "43"]))
