"""Classes, labels and flags of events as they are shown and exported."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import canonical, fold, loose_key
from .lexicon import MONTHS
from .names import lookup

# Kinds and statuses of extraction results as those of events.
KINDS = {"closure": "closure", "transfer": "closure", "threatened_closure": "closure", "regroupement": "fusion", "merge": "fusion"}
STATUSES = {"confirmed": "confirmed", "announced": "project", "contested": "rumour", "threatened": "rumour", "unclear": "rumour"}
# What becomes of a postal point, with its label.
IMPACTS = {"complete": "Services Banque Postale supprimés", "partner office": "Conversion en agence postale communale", "relay": "Conversion en relais Poste", "banking service": "Service bancaire fermé", "cash machine": "Distributeur supprimé"}
FULL_OFFICES = ["bureau de poste", "bureau centre"]
PARTNERS = ["agence postale communale", "agence postale intercommunale", "agence postale communale ou intercommunale", "relais poste", "point partenaire", "agence postale ou relais poste"]
# What sources of the local press and of legal notices are called.
LOCAL_PRESS = ["google news", "actu", "ouest-france", "ouest france", "ici", "est republicain", "nouvelle republique", "dna", "info-chalon", "info chalon", "delta fm", "europesays", "europe says", "bien public", "progres", "dauphine", "sud ouest", "voix du nord", "france bleu", "republicain lorrain", "paris-normandie", "depeche", "telegramme", "brave", "bing", "sitemap", "presse"]
LEGAL = ["legifrance"]
# What tells of a transfer to come, folded.
TRANSFERS = ["a compter du", "transfere ses activites", "transferera ses activites", "transfere son activite", "sera rattache a", "sera rattachee a", "fermera definitivement", "fermeture definitive", "regroupement avec", "transfert de votre agence"]
# What stands for a missing municipality, and more spellings of brands in texts, as keys.
NO_PLACE = ["", "null", "undefined", ".", "-", "inconnu", "inconnue", "non renseignee", "non renseigne"]
MORE_SPELLINGS = {"bnp paribas": ["bnp"], "caisse d epargne": ["caisse epargne"], "la banque postale": ["banque postale"], "credit mutuel": ["cmb"]}
SURE = 4


def event_class(kind: Column, status: Column) -> Column:
    """fusion before project before rumour before confirmed."""
    return F.when(kind == "fusion", "fusion").when(status == "project", "project").when(status == "rumour", "rumour").otherwise("confirmed")


def event_kind(c: Column) -> Column:
    return lookup(c, KINDS, "closure")


def event_status(c: Column) -> Column:
    return lookup(c, STATUSES, "rumour")


def effective_status(day: Column, stored: Column, today: Column) -> Column:
    """Upcoming from ``today`` on, closed before; without a day what is stored."""
    return F.when(day >= today, "upcoming").when(day.isNotNull(), "closed").otherwise(F.coalesce(stored, F.lit("unknown")))


def display_date(*days: Column) -> Column:
    return F.coalesce(*[d.cast("date") for d in days])


def is_full_office(characteristic: Column) -> Column:
    return F.coalesce(canonical(characteristic).isin(FULL_OFFICES), F.lit(False))


def is_partner(characteristic: Column) -> Column:
    return F.coalesce(canonical(characteristic).isin(PARTNERS), F.lit(False))


def impact_class(replacement: Column) -> Column:
    """What a postal point becomes, by the kind of the point that takes its place; null for none."""
    key = canonical(F.coalesce(replacement, F.lit("")))
    return F.when(key.contains("agence postale"), "partner office").when(key.contains("relais") | key.contains("partenaire"), "relay").otherwise("complete")


def impact_label(impact: Column) -> Column:
    return F.coalesce(lookup(impact, IMPACTS), impact, F.lit(""))


def source_class(source: Column) -> Column:
    """local or legal, by what the source's name holds; null for neither."""
    key = fold(F.coalesce(source, F.lit("")))
    holds = lambda names: key.rlike("|".join(names))
    return F.when(holds(LEGAL), "legal").when(holds(LOCAL_PRESS), "local")


def future_transfer(c: Column) -> Column:
    return F.coalesce(fold(c).rlike("|".join(TRANSFERS)), F.lit(False))


def deep_window(since: Column, today: Column, least_days: int) -> Column:
    """A window that goes back ``least_days`` or more; none without a start."""
    return F.coalesce(F.datediff(today, since) >= least_days, F.lit(False))


def meaningful_place(place: Column) -> Column:
    return ~fold(F.trim(F.coalesce(place, F.lit("")))).isin(NO_PLACE)


def needs_review(place: Column, day: Column, reliability: Column, status: Column) -> Column:
    """An event without place or date, not sure, or not confirmed."""
    return ~meaningful_place(place) | day.isNull() | (F.coalesce(reliability, F.lit(0)) < SURE) | ~status.eqNullSafe(F.lit("confirmed"))


def locator_message(c: Column) -> Column:
    """struct(day, branch_code, destination) of a locator's message, nulls where it does not say."""
    t = fold(c)
    part = lambda p, i: F.regexp_extract(t, p, i)
    written = rf"(\d{{1,2}})\s+({'|'.join(MONTHS)})\s+(\d{{4}})"
    slashed = r"(\d{1,2})/(\d{1,2})/(\d{4})"
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), part(written, 2)).cast("string")
    day = F.when(t.rlike(written), F.try_to_date(F.concat_ws("-", part(written, 3), month, part(written, 1)), "y-M-d")).otherwise(F.try_to_date(F.concat_ws("-", part(slashed, 3), part(slashed, 2), part(slashed, 1)), "y-M-d"))
    some = lambda x: F.nullif(F.trim(x), F.lit(""))
    return F.struct(day.alias("day"), some(F.regexp_extract(c, r"\((\d{4,5})\)", 1)).alias("branch_code"), some(F.regexp_extract(c, r"vers l['’]agence de\s+([^().]+)", 1)).alias("destination"))


def brand_said(c: Column, brand: str) -> Column:
    """The text names the brand, by its name or another of its spellings, as whole words."""
    from .terms import folded

    name = " ".join(folded(brand).replace("'", " ").replace("-", " ").split())
    return F.concat(F.lit(" "), loose_key(c), F.lit(" ")).rlike(f" (?:{'|'.join([name, *MORE_SPELLINGS.get(name, [])])}) ")
