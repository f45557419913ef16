"""Filing codes, yearly metrics, growth, indicators and income-statement flows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.constants import (
    AMOUNT_PATTERN, CHARGES, COST_OF_SALES, CSV_CELL, ENTITY_NAME, GROSS, KPI_CODES, LOSS, LOSS_NODES, METRIC_CODES, NET,
    OPERATING_CHARGES, OPERATING_RESULT, PERIOD_END, PRETAX, PROFIT_NODES, REVENUE, SUMMED_CODES, TAX,
)
from ledgerline.functions.dates import fiscal_year_of, year_number
from ledgerline.functions.numbers import first_amount, parse_amount, percent, ratio, sum_or_first, zero_if_null
from ledgerline.functions.text import none_if_empty
from ledgerline.operators.picks import last_per_key
from ledgerline.operators.scale import lookup

METRICS = [
    "ca", "achats", "variation_stocks", "marge_brute", "charges_exploitation", "ebit", "resultat_avant_impots", "impots",
    "resultat_net", "tresorerie", "dettes_financieres", "fonds_propres", "capital_souscrit",
]
RATIOS = ["marge_nette", "roe", "ratio_liquidite", "taux_endettement"]


def code_variants() -> dict[str, list[str]]:
    """Metric to the accounting codes it may come from."""
    return METRIC_CODES | {metric: parts + totals for metric, (parts, totals) in SUMMED_CODES.items()}


def filing_columns() -> list[str]:
    """Code columns of one filing, each once: those of the metrics and the period end."""
    return list(dict.fromkeys(code for codes in code_variants().values() for code in codes)) + [PERIOD_END]


def usable_lines(lines: DataFrame) -> DataFrame:
    """Lines of a needed code with a value; runs before any join."""
    return lines.where(F.col("code").isin(filing_columns()) & (F.col("val") != ""))


def of_targets(facts: DataFrame, targets: DataFrame) -> DataFrame:
    """Facts of the listed enterprises only."""
    return lookup(facts, targets.select("num"), ["num"], "left_semi")


def last_code_values(lines: DataFrame) -> DataFrame:
    """Last value of each code inside one filing, in long form."""
    return lines.groupBy("num", "reference", "code").agg(F.max_by("val", "pos").alias("val"))


def filing_amounts(lines: DataFrame) -> DataFrame:
    """One row per filing: the last amount per code, and the year of the period end.

    Every line is parsed once to a number. With a numeric line position all buffers are
    fixed-width, so this is a hash aggregate that combines map-side: the lines are neither
    sorted nor gathered, however many a single enterprise has.
    """
    number = F.when(F.col("code") == PERIOD_END, year_number(F.col("val"))).otherwise(parse_amount(F.col("val")))
    parsed = lines.withColumn("amount", number)
    return parsed.groupBy("num", "reference").agg(
        *[F.max_by("amount", F.when(F.col("code") == c, F.col("pos"))).alias(c) for c in filing_columns()]
    )


def _amount(code: str) -> Column:
    return F.col(f"`{code}`")


def with_metrics(filings: DataFrame) -> DataFrame:
    """Yearly metrics and ratios of each filing; a missing code stays NULL."""
    out = filings
    for name, codes in METRIC_CODES.items():
        out = out.withColumn(name, first_amount([_amount(c) for c in codes]))
    for name, (parts, totals) in SUMMED_CODES.items():
        out = out.withColumn(name, sum_or_first([_amount(c) for c in parts], [_amount(c) for c in totals]))
    ca, net, equity = F.col("ca"), F.col("resultat_net"), F.col("fonds_propres")
    sound = equity > 0
    out = out.withColumns({
        "marge_brute": ca - zero_if_null(F.col("achats")) + zero_if_null(F.col("variation_stocks")),
        "charges_exploitation": ca - F.col("ebit"),
        "impots": F.col("resultat_avant_impots") - net,
        "fonds_propres_negatifs": F.coalesce(equity <= 0, F.lit(False)),
        "marge_nette": ratio(net, ca, 100),
        "roe": F.when(sound, ratio(net, equity, 100)),
        "ratio_liquidite": ratio(F.col("tresorerie"), F.col("dettes_financieres")),
        "taux_endettement": F.when(sound, ratio(F.col("dettes_financieres"), equity, 100)),
    })
    keep = [c for c in ("num", "year", "reference") if c in filings.columns]
    return out.select(*keep, *METRICS, "fonds_propres_negatifs", *RATIOS)


def filing_year(filings: DataFrame) -> DataFrame:
    """The fiscal year of each filing, from its period end, else from its reference."""
    return filings.withColumn("year", fiscal_year_of(_amount(PERIOD_END), F.col("reference")))


def one_filing_per_year(filings: DataFrame) -> DataFrame:
    """The highest reference of each fiscal year."""
    return last_per_key(filings if "year" in filings.columns else filing_year(filings), ["num", "year"], "reference")


def with_growth(yearly: DataFrame) -> DataFrame:
    """Revenue growth against the last earlier year with revenue, as a fraction.

    One row per (enterprise, year): a window never holds more rows than there are years.
    """
    w = Window.partitionBy("num").orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    before = F.last("ca", ignorenulls=True).over(w)
    return yearly.withColumn("croissance_ca", ratio(F.col("ca") - before, before))


def yearly_metrics(lines: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """Metrics, ratios and growth per enterprise and year, from raw filing lines."""
    usable = usable_lines(lines)
    if targets is not None:
        usable = of_targets(usable, targets)
    return with_growth(with_metrics(one_filing_per_year(filing_amounts(usable))))


def schema_type(revenue: Column, equity: Column) -> Column:
    """Aggregate: ``full`` with any revenue, ``abrege`` with any equity, else ``micro``."""
    return (
        F.when(F.bool_or(revenue.isNotNull()), "full").when(F.bool_or(equity.isNotNull()), "abrege").otherwise("micro")
    )


def gold(yearly: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per enterprise with its sorted years (at most one per fiscal year)."""
    year = F.struct("year", "reference", *METRICS, "fonds_propres_negatifs", F.struct(*RATIOS, "croissance_ca").alias("ratios"))
    grouped = yearly.groupBy("num").agg(
        schema_type(F.col("ca"), F.col("fonds_propres")).alias("schema_type"),
        F.count("*").cast("int").alias("nb_exercices"),
        F.sort_array(F.collect_list(year)).alias("years"),
    )
    return grouped.join(targets.select("num", "denomination", "nace_codes"), "num", "left")


def latest_year(yearly: DataFrame) -> DataFrame:
    return last_per_key(yearly, ["num"], "year")


def chosen_year(yearly: DataFrame, year: str) -> DataFrame:
    """The asked year where it exists, else the latest."""
    return last_per_key(yearly, ["num"], (F.col("year") == year).alias("asked"), "year")


# --- filing indicators -------------------------------------------------------


def csv_codes(accounts: DataFrame, keys: list[str]) -> DataFrame:
    """Code, value and amount of every line of a filing's CSV text after its first line."""
    lines = accounts.select(*keys, F.posexplode(F.split("raw_csv", "\n")).alias("line_no", "line"))
    lines = lines.where((F.col("line_no") > 0) & (F.trim("line") != ""))
    code, value = (csv_cell(F.regexp_extract("line", rf"^[ \t]*{CSV_CELL}[ \t]*,[ \t]*{CSV_CELL}", i)) for i in (1, 2))
    cells = lines.select(*keys, "line_no", F.trim(code).alias("code"), none_if_empty(value).alias("val"))
    return cells.withColumn("amount", parse_float(F.col("val")))


def csv_cell(cell: Column) -> Column:
    """Text of a cell: quotes around it taken off, doubled quotes inside it single."""
    inner = F.replace(F.substr(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))
    return F.when(cell.startswith('"'), inner).otherwise(F.trim(cell))


def parse_float(text: Column) -> Column:
    """Plain number; NULL when the text is no number."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(AMOUNT_PATTERN), trimmed.try_cast("double"))


def eligible(accounts: DataFrame) -> DataFrame:
    """Filings with a CSV: not migrated, text not blank."""
    return accounts.where(~F.coalesce(F.col("migration"), F.lit(False)) & (F.trim("raw_csv") != ""))


def csv_pairs(raw: Column, codes: list[str]) -> Column:
    """Lines of the given codes after the first line, as ``code,value`` cells in line order.

    One pattern goes over the text once, from line start to line start; lines of other codes are passed over by the matcher.
    """
    some = "|".join(rf"\Q{c}\E" for c in codes)
    return F.regexp_extract_all(raw, F.lit(rf'(?<=\n)[ \t]*(?:"(?:{some})"|(?:{some}))[ \t]*,[ \t]*{CSV_CELL}'), F.lit(0))


def last_values(accounts: DataFrame, keys: list[str], codes: list[str]) -> DataFrame:
    """Text of the last line of each code as a column of that name; NULL when the code is absent or its value empty.

    The text is matched once. The lines found are few: their codes and values become two arrays in reverse line order, and
    the first place of a code in the one names its value in the other.
    """
    # the one-element explodes keep each step from being evaluated for each of its uses
    found = accounts.select(*keys, F.explode(F.array(F.reverse(csv_pairs(F.col("raw_csv"), codes)))).alias("found"))
    cells = found.select(*keys, F.explode(F.array(F.struct(
        F.transform("found", lambda x: F.btrim(F.substring_index(x, ",", 1), F.lit('" \t'))).alias("codes"),
        F.transform("found", lambda x: none_if_empty(F.trim(csv_cell(F.ltrim(F.substr(x, F.locate(",", x) + 1), F.lit(" \t")))))).alias("vals"),
    ))).alias("c"))
    return cells.select(*keys, *[F.get("c.vals", (F.array_position("c.codes", c) - 1).cast("int")).alias(c) for c in codes])


def code_table(accounts: DataFrame, keys: list[str]) -> DataFrame:
    """Last amount per code of each filing, no shuffle; a filing with an unreadable used code is left out."""
    used = KPI_CODES + ["670/3"]
    values = last_values(accounts, keys, [*used, ENTITY_NAME, PERIOD_END])
    broken = F.lit(False)
    for c in KPI_CODES:
        broken = broken | (_amount(c).isNotNull() & parse_float(_amount(c)).isNull())
    return values.where(~broken).select(
        *keys, *[parse_float(_amount(c)).alias(c) for c in used], _amount(ENTITY_NAME).alias("entity"),
        _amount(PERIOD_END).alias("period_end"),
    )


def with_kpis(filings: DataFrame, keys: list[str]) -> DataFrame:
    """Sixteen indicators per filing; a missing code counts as 0."""

    def get(code: str) -> Column:
        return zero_if_null(_amount(code))

    revenue, equity, assets = get("70"), get("10/15"), get("20/58")
    gross, ebitda = revenue - get("60"), get("9901") + get("630")
    debt, cash = get("17") + get("43"), get("54/58")
    return filings.select(
        *keys, "entity", "period_end", revenue.alias("chiffre_affaires"), gross.alias("marge_brute"),
        ebitda.alias("ebitda"), get("9901").alias("ebit"), get("9904").alias("resultat_net"),
        percent(gross, revenue).alias("taux_marge_brute"), percent(ebitda, revenue).alias("taux_ebitda"),
        percent(get("9904"), revenue).alias("marge_nette"), cash.alias("tresorerie"), debt.alias("dettes_fin"),
        (debt - cash).alias("dette_nette"), equity.alias("fonds_propres"), assets.alias("total_actif"),
        percent(equity, assets).alias("autonomie_fin"),
    )


def filing_kpis(accounts: DataFrame) -> DataFrame:
    """Indicators of every eligible filing."""
    keys = ["deposit_id", "num", "period_year", "reference"]
    return with_kpis(code_table(eligible(accounts), keys), keys)


# --- flows -------------------------------------------------------------------


def _edge(source: str, target: str, value: Column) -> Column:
    return F.struct(F.lit(source).alias("source"), F.lit(target).alias("target"), value.alias("value"))


def _kept(edges: list[Column]) -> Column:
    return F.filter(F.array(*edges), lambda e: e["value"] > 0)


def flow_graph(yearly: DataFrame) -> DataFrame:
    """Flow links and linked nodes per (enterprise, year): loss variant or profit waterfall.

    Node numbers are positions in the row's own node list; no global numbering.
    """
    ca, ebit, net = F.col("ca"), F.col("ebit"), F.col("resultat_net")
    deficit = F.coalesce(net < 0, F.lit(False))
    loss = _kept([_edge(REVENUE, CHARGES, ca), _edge(LOSS, CHARGES, -net)])
    profit = _kept([
        _edge(REVENUE, OPERATING_CHARGES, ca - ebit), _edge(REVENUE, OPERATING_RESULT, ebit),
        _edge(OPERATING_RESULT, PRETAX, F.col("resultat_avant_impots")), _edge(PRETAX, NET, net),
        _edge(PRETAX, TAX, F.col("impots")),
    ])
    at_loss = deficit & F.coalesce(ca > 0, F.lit(False))
    links = F.when(at_loss, loss).otherwise(profit)
    order = F.when(at_loss, F.array(*map(F.lit, LOSS_NODES))).otherwise(F.array(*map(F.lit, PROFIT_NODES)))
    out = yearly.select("num", "year", deficit.alias("deficit"), links.alias("links"), order.alias("node_order"))
    linked = F.concat(F.transform("links", lambda e: e["source"]), F.transform("links", lambda e: e["target"]))
    return out.withColumn("nodes", F.array_intersect("node_order", linked)).drop("node_order")


def flow_links(graph: DataFrame) -> DataFrame:
    """One row per link, named and numbered."""
    exploded = graph.select("num", "year", "deficit", "nodes", F.posexplode("links").alias("link_no", "e"))
    return exploded.select(
        "num", "year", "deficit", "link_no", F.col("e.source").alias("source"), F.col("e.target").alias("target"),
        (F.array_position("nodes", F.col("e.source")) - 1).cast("int").alias("source_index"),
        (F.array_position("nodes", F.col("e.target")) - 1).cast("int").alias("target_index"),
        F.round("e.value", 2).alias("value"),
    )


def flow_nodes(graph: DataFrame) -> DataFrame:
    return graph.select("num", "year", F.posexplode("nodes").alias("node_index", "name"))


def detailed_flow(filings: DataFrame, keys: list[str]) -> DataFrame:
    """Flow with a cost-of-sales step when it exceeds 1 % of revenue, from one filing's codes."""

    def get(code: str) -> Column:
        return zero_if_null(_amount(code))

    ca, cost, ebit, tax, net = get("70"), get("60"), get("9901"), get("670/3"), get("9904")
    gross = ca - cost
    opex, pretax = F.greatest(gross - ebit, F.lit(0.0)), net + tax
    tail = [_edge(OPERATING_RESULT, PRETAX, pretax), _edge(PRETAX, NET, net), _edge(PRETAX, TAX, tax)]
    goods = F.array(
        _edge(REVENUE, GROSS, gross), _edge(REVENUE, COST_OF_SALES, cost), _edge(GROSS, OPERATING_RESULT, ebit),
        _edge(GROSS, OPERATING_CHARGES, opex), *tail,
    )
    services = F.array(_edge(REVENUE, OPERATING_RESULT, ebit), _edge(REVENUE, OPERATING_CHARGES, opex), *tail)
    edges = F.when(cost > ca * 0.01, goods).otherwise(services)
    return filings.select(*keys, F.posexplode(edges).alias("link_no", "e")).select(
        *keys, "link_no", "e.source", "e.target", F.round("e.value", 2).alias("value")
    )


# --- reports -----------------------------------------------------------------


def unpivot_metrics(yearly: DataFrame, metrics: list[str]) -> DataFrame:
    """Long form (enterprise, year, indicator, value)."""
    return yearly.unpivot(["num", "year"], metrics, "indicator", "value")


def year_columns(long: DataFrame, years: list[str] | None = None) -> DataFrame:
    """Indicators as rows and the years as columns: the given ones, or all that occur."""
    return long.groupBy("num", "indicator").pivot("year", years).agg(F.first("value"))


def code_frequency(lines: DataFrame) -> DataFrame:
    """In how many filings each code occurs."""
    return lines.where("num IS NOT NULL AND reference IS NOT NULL").select("num", "reference", "code").distinct().groupBy("code").count()


def code_coverage(lines: DataFrame) -> DataFrame:
    """Per metric: the best variant's count and its share of all filings."""
    variants = code_variants()
    present = lines.select("num", "reference", "code").groupBy("num", "reference").agg(
        *[F.bool_or(F.col("code") == c).cast("int").alias(c) for c in sorted({c for v in variants.values() for c in v})]
    )
    totals = present.agg(
        F.count("*").alias("n"),
        *[F.greatest(*[F.coalesce(F.sum(f"`{c}`"), F.lit(0)) for c in codes], F.lit(0)).alias(m) for m, codes in variants.items()],
    )
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("best")) for m in variants]))
    return totals.select("n", rows.alias("r")).select(
        "r.metric", "r.best", "n", F.round(F.coalesce(F.try_divide(F.col("r.best") * 100, F.col("n")), F.lit(0.0)), 1).alias("share")
    )
