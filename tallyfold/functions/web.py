"""Hosts, source tiers and the clean-up of markup in titles and texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import once, text

# Hosts of the source tiers.
TIER_A = ["credit-agricole.fr", "sg.fr", "labanquepostale.fr", "caisse-epargne.fr", "banquepopulaire.fr", "creditmutuel.fr", "cic.fr", "lcl.fr", "bnpparibas.fr", "bnpparibas.com", "boursobank.com", "hsbc.fr", "ing.fr", "fortuneo.fr", "monabanq.com", "hellobank.fr", "caissedesdepots.fr", "mairie.fr"]
TIER_B = ["ouest-france.fr", "sudouest.fr", "ladepeche.fr", "lavoixdunord.fr", "lanouvellerepublique.fr", "ledauphine.com", "estrepublicain.fr", "republicain-lorrain.fr", "paris-normandie.fr", "lamontagne.fr", "leprogres.fr", "letelegramme.fr", "nicematin.com", "midilibre.fr", "lindependant.fr", "leparisien.fr", "lyoncapitale.fr", "lyonmag.com", "lunion.fr", "lejsl.com", "courrier-picard.fr", "voixdunord.fr", "lalsace.fr", "dna.fr", "bienpublic.com", "lepays.fr", "lopinion.fr", "latribune.fr", "lesechos.fr", "lefigaro.fr", "lemonde.fr", "liberation.fr"]
TIER_C = ["francetvinfo.fr", "france3-regions.francetvinfo.fr", "france3.fr", "ici.fr", "francebleu.fr", "actu.fr", "bfmtv.com", "rfi.fr", "rtl.fr", "europe1.fr", "20minutes.fr"]
TIER_E = ["facebook.com", "twitter.com", "x.com", "instagram.com", "linkedin.com", "youtube.com", "pagesjaunes.fr", "tiktok.com", "snapchat.com", "reddit.com", "tripadvisor.fr", "tripadvisor.com", "yelp.fr", "yelp.com", "avis-verifies.com", "trustpilot.com"]
A_PATTERN = r"(^|\.)gouv\.fr$|mairie|bnpparibas"
#: Of the search engine only maps and reviews are of the last tier, told by the host or the path; its news pages are not.
E_URL = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?(?:www\.)?(?:maps\.google\.[^/?#]*|(?!news\.google\.com(?:[:/?#]|$))[^/?#]*google\.[^/?#]*/[^?#]*(?:maps|avis|reviews|business))"
TIERS = [("A", TIER_A, A_PATTERN), ("B", TIER_B, None), ("C", TIER_C, None), ("E", TIER_E, None)]

# Character references that titles hold.
REFERENCES = {"&nbsp;": " ", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&lt;": "<", "&gt;": ">", "&middot;": "·", "&copy;": "©", "&amp;": "&"}


def host(url: Column | str) -> Column:
    """Host of a URL in lower case without a leading www."""
    found = F.regexp_extract(text(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)
    return F.regexp_replace(F.lower(found), r"^\.*(?:www\.)?", "")


def under(hosts: list[str]) -> str:
    """A pattern for hosts that are one of ``hosts`` or below it."""
    return r"(?:^|\.)(?:" + "|".join(h.replace(".", r"\.") for h in hosts) + r")\z"


def source_tier(url: Column | str, tiers: list[tuple[str, list[str], str | None]] = TIERS, default: str = "D", last: tuple[str, str] | None = ("E", E_URL)) -> Column:
    """First tier that has the host, a domain above it, or a host like its pattern; else the tier of ``last`` if the URL is like that."""

    def of(h: Column) -> Column:
        out = F.when(F.coalesce(h, F.lit("")) == "", F.lit(default))
        for name, hosts, pattern in tiers:
            hit = h.rlike(under(hosts))
            out = out.when(hit | h.rlike(pattern) if pattern else hit, F.lit(name))
        if last is not None:
            out = out.when(text(url).rlike(last[1]), F.lit(last[0]))
        return out.otherwise(default)

    return once(host(url), of)


def unescape(c: Column) -> Column:
    for k, v in REFERENCES.items():
        c = F.replace(c, F.lit(k), F.lit(v))
    return c


def clean_text(c: Column | str) -> Column:
    """References resolved, tags as sentence ends, URLs and a trailing " - Publisher" gone."""
    t = F.regexp_replace(unescape(text(c)), r"<[^>]+>", ". ")
    t = F.regexp_replace(t, r"https?://\S+", " ")
    return F.trim(F.regexp_replace(t, r" - [^-]{2,60}$", ""))


def page_title(html: Column | str) -> Column:
    return F.trim(F.regexp_replace(unescape(F.regexp_extract(text(html), r"(?is)<title[^>]*>(.*?)</title>", 1)), r"\s+", " "))


def page_text(html: Column | str, limit: int = 20_000) -> Column:
    """Text of a page by tag stripping, cut at ``limit`` characters."""
    t = F.regexp_replace(text(html), r"(?is)<(script|style|nav|footer|head)[^>]*>.*?</\1>", " ")
    t = F.regexp_replace(t, r"(?s)<!--.*?-->|<[^>]*>", " ")
    return F.substring(F.trim(F.regexp_replace(unescape(t), r"\s+", " ")), 1, limit)
