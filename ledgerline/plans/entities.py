"""Enterprise records: rich, silver, sector targets, translated records, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.constants import SEAT_TYPES, SECTOR_CODES
from ledgerline.functions.dates import iso_date
from ledgerline.functions.keys import clean_number
from ledgerline.functions.text import bilingual_line, none_if_empty, postal_line
from ledgerline.operators import picks
from ledgerline.operators.filters import sector_enterprises
from ledgerline.operators.lookups import Decoder, code_labels, decode_activities, nace_category, resolve_officers
from ledgerline.operators.merge import not_done, purge, upsert_targets
from ledgerline.operators.nest import Record, record
from ledgerline.operators.rollups import zero_filled

ADDRESS = ["type_of_address", "street_fr", "street_nl", "house_number", "zipcode", "municipality_fr", "municipality_nl"]
ACTIVITY = ["activity_group", "nace_version", "nace_code", "classification"]
LABELS = ["group_fr", "group_nl", "classification_fr", "classification_nl", "nace_fr", "nace_nl"]


def rich(
    enterprises: DataFrame, activities: DataFrame, addresses: DataFrame, branches: DataFrame, contacts: DataFrame,
    establishments: DataFrame, denominations: DataFrame, codes: DataFrame, done: DataFrame | None = None,
) -> Record:
    """Enterprises with their six child tables, activities decoded; ``done`` keys are left out."""
    if done is not None:
        enterprises = enterprises.join(done.select("num").distinct(), "num", "left_anti")
    return record(
        enterprises,
        {
            "activites": (decode_activities(activities, codes), ACTIVITY + LABELS),
            "adresses": (addresses, ADDRESS),
            "succursales": (branches.withColumn("pos", F.col("branch_id")), ["branch_id", "branch_name"]),
            "contacts": (contacts, ["contact_type", "value"]),
            "etablissements": (establishments.withColumn("pos", F.col("establishment_number")), ["establishment_number", "start_date"]),
            "denominations": (denominations, ["language", "type_code", "valeur"]),
        },
        raw={"activites": [activities]},
    )


def silver(
    enterprises: DataFrame, activities: DataFrame, addresses: DataFrame, denominations: DataFrame, documents: DataFrame,
    accounts: list[DataFrame], cards: DataFrame | None = None, publications: DataFrame | None = None,
) -> Record:
    """One cleaned record per enterprise.

    Seat addresses, first activity per code and class, ISO dates. A card or publication source has one row per
    enterprise; an absent one adds no struct. Account sources are concatenated in the given order.
    """
    # A landed register has its key, so that the record stays co-partitioned with its children.
    base = enterprises if "num" in enterprises.columns else enterprises.withColumn("num", clean_number(F.col("enterprise_number")))
    base = base.withColumn("date_creation", iso_date(F.col("start_date"))).drop("enterprise_number", "start_date")
    for name, side in (("kbopub", cards), ("ejustice", publications)):
        if side is not None:
            one = side.select("num", F.struct(*[c for c in side.columns if c != "num"]).alias(name))
            base = base.join(picks.first_per_key(one, ["num"], name), "num", "left")
    fields = ["deposit_id", "reference", "period_year"]
    stacked = None
    for i, source in enumerate(accounts):
        marked = source.select(F.col("num"), *fields, F.struct(F.lit(i).alias("src"), "deposit_id").alias("pos"))
        stacked = marked if stacked is None else stacked.unionByName(marked)
    children = {
        "denominations": (denominations, ["language", "type_code", "valeur"]),
        "adresses": (addresses.where(F.col("type_of_address").isin(SEAT_TYPES)), ADDRESS),
        "activites": (picks.dedup_activities(activities), ACTIVITY),
        "documents": (documents.withColumn("num", F.col("enterprise")).withColumn("pos", F.col("path")),
                      ["source", "year", "filename", "path"]),
    }
    if stacked is not None:
        children["comptes_annuels"] = (stacked, fields)
    return record(base, children, raw={"comptes_annuels": accounts} if accounts else None)


def silver_of_rich(
    of: Record, documents: DataFrame, accounts: list[DataFrame], cards: DataFrame | None = None, publications: DataFrame | None = None,
) -> Record:
    """Silver built on rich records: activities keep their labels, seats are cut out, the other child tables are taken over."""
    c = of.children
    out = silver(of.base, c["activites"], c["adresses"], c["denominations"], documents, accounts, cards, publications)
    own = {"activites": picks.dedup_activities(c["activites"]), **{n: c[n] for n in ("succursales", "contacts", "etablissements")}}
    return out._replace(children={**out.children, **own})


def matched_codes(activities: DataFrame) -> DataFrame:
    """Sector codes of the main activity (trimmed), sorted and distinct, per enterprise."""
    main = activities.where(F.trim(F.coalesce("classification", F.lit(""))) == "MAIN")
    code = F.trim(F.coalesce("nace_code", F.lit("")))
    hit = main.where(code.isin(SECTOR_CODES)).groupBy("num")
    # at most one entry per listed code, so the set is bounded
    return hit.agg(F.sort_array(F.collect_set(code)).alias("nace_codes"))


def sector_list(enterprises: DataFrame, activities: DataFrame, denominations: DataFrame) -> DataFrame:
    """Selected enterprises with matched codes, legal form and name."""
    selected = sector_enterprises(enterprises, activities).select("num", "juridical_form")
    names = picks.first_per_key(denominations.select("num", "valeur", "pos"), ["num"], "pos")
    names = names.select("num", F.col("valeur").alias("denomination"))
    out = selected.join(matched_codes(activities), "num", "left").join(names, "num", "left")
    return out.withColumn("nace_codes", F.coalesce("nace_codes", F.array().cast("array<string>")))


def refresh_targets(state: DataFrame, selected: DataFrame, run: int) -> DataFrame:
    """Upsert the selection (new keys start as pending), then drop what this run did not see."""
    new = selected.withColumn("updated_run", F.lit(run))
    merged = upsert_targets(state, new, {"status": F.lit("pending"), "created_run": F.lit(run)})
    return purge(merged, F.lit(run))


def translated(
    enterprises: DataFrame, denominations: DataFrame, addresses: DataFrame, establishments: DataFrame, codes: DataFrame,
    lang: str = "FR",
) -> DataFrame:
    """One readable row per enterprise in French or Dutch."""
    decoder = Decoder(codes, code_labels(codes))
    seat = picks.seat_addresses(addresses).drop("later")
    counts = establishments.groupBy("num").agg(F.count("*").alias("nb_etablissements"))
    out = enterprises.join(picks.names_in_language(denominations, lang), "num", "left").join(seat, "num", "left")
    out = zero_filled(out, counts, "num", "nb_etablissements")
    for category, code, name in (
        ("Status", "status", "statut"), ("JuridicalSituation", "juridical_situation", "situation"),
        ("JuridicalForm", "juridical_form", "forme"), ("TypeOfEnterprise", "type_of_enterprise", "type_entreprise"),
        ("TypeOfAddress", "type_of_address", "type_adresse"),
    ):
        out = decoder.label(out, F.lit(category), code, name, lang)
    own = "fr" if lang == "FR" else "nl"
    street = F.coalesce(none_if_empty(F.col(f"street_{own}")), none_if_empty(F.col("street_nl")))
    address = bilingual_line(street, F.col("house_number"), F.col("zipcode"), F.col(f"municipality_{own}"))
    return out.select(
        "num", "nom", "statut", "situation", "forme", "type_entreprise", F.col("start_date").alias("date_creation"),
        address.alias("adresse"), "type_adresse", "nb_etablissements",
    )


def translated_activities(activities: DataFrame, codes: DataFrame, lang: str = "FR") -> DataFrame:
    """Activities with the labels of class, code and group in one language."""
    decoder = Decoder(codes, code_labels(codes))
    out = decoder.label(activities, F.lit("Classification"), "classification", "classe", lang)
    out = decoder.label(out, nace_category(), "nace_code", "description", lang)
    return decoder.label(out, F.lit("ActivityGroup"), "activity_group", "groupe", lang)


def address_lines(addresses: DataFrame) -> DataFrame:
    """Postal line of each enterprise's first registered seat."""
    seats = addresses.where(F.col("type_of_address").isin(SEAT_TYPES))
    first = picks.first_per_key(seats, ["num"], "pos")
    line = postal_line(F.col("street_fr"), F.col("house_number"), F.col("zipcode"), F.col("municipality_fr"))
    return first.select("num", line.alias("adresse"))


def profiles(
    gold: DataFrame, enterprises: DataFrame, denominations: DataFrame, addresses: DataFrame, cards: DataFrame
) -> DataFrame:
    """Company profile for every key that is in gold or in the register."""
    register = (
        enterprises.select("num", "juridical_form", "status", "type_of_enterprise", F.lit(True).alias("in_register"))
        .join(picks.display_names(denominations).withColumnRenamed("denomination", "register_name"), "num", "left")
        .join(address_lines(addresses), "num", "left")
    )
    both = gold.withColumn("in_gold", F.lit(True)).join(register, "num", "full").join(cards, "num", "left")
    return both.withColumns({
        "denomination": F.coalesce("register_name", "denomination"), "in_gold": F.coalesce("in_gold", F.lit(False)),
        "in_register": F.coalesce("in_register", F.lit(False)),
    }).drop("register_name")


def profile_record(
    enterprises: DataFrame, activities: DataFrame, codes: DataFrame, officers: DataFrame, denominations: DataFrame, yearly: DataFrame,
    cards: Record | None = None,
) -> Record:
    """Profiles with their long tables: decoded activities, resolved officers in page order, fiscal years in ascending order.

    With web cards also the card's groups (contact, financial data, outbound links and the rest) and the linked entities.
    """
    by_year = Window.partitionBy("num").orderBy("year")  # one row per enterprise and year
    named = resolve_officers(officers, denominations).withColumn("pos", F.col("row_no"))
    base = enterprises.select("num", "juridical_form", "status", "type_of_enterprise")
    linked = {}
    if cards is not None:
        base = base.join(cards.base, "num", "left")
        linked["liens_entites"] = (cards.children["liens_entites"], ["bce", "nom", "texte"])
    return record(
        base,
        {
            "activites": (decode_activities(activities, codes), ACTIVITY + LABELS),
            "dirigeants": (named, ["fonction", "nom", "depuis", "ref_bce", "is_company"]),
            "annees": (yearly.withColumn("pos", F.row_number().over(by_year)), ["year", "ca", "resultat_net", "fonds_propres"]),
            **linked,
        },
        raw={"activites": [activities], "annees": [yearly]},
    )


def officer_list(officers: DataFrame, denominations: DataFrame) -> DataFrame:
    return resolve_officers(officers, denominations)


def todo(enterprises: DataFrame, checkpoints: DataFrame, source: str, force: bool = False) -> DataFrame:
    """Active enterprises a source still has to process."""
    active = enterprises.where("status = 'AC'").select("num")
    return not_done(active, checkpoints, source, force)
