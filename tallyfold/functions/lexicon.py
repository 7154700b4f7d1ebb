"""Default vocabularies of the triage of closure reports; every operator takes its own instead."""

from __future__ import annotations

from dataclasses import dataclass, field

# Brands with their spellings, the canonical one first.
BRANDS: dict[str, list[str]] = {
    "Crédit Agricole": ["Crédit Agricole", "CA Centre-Est", "CA Loire Haute-Loire"],
    "BNP Paribas": ["BNP Paribas", "BNP"],
    "Société Générale": ["Société Générale", "SG", "Banque Courtois", "Banque Laydernier", "Banque Tarneaud", "Banque Kolb", "Banque Rhône-Alpes"],
    "Banque Populaire": ["Banque Populaire", "BPGO", "BPALC", "BRED"],
    "Caisse d'Épargne": ["Caisse d'Épargne", "CEBPL", "CEGEE", "CELC"],
    "Crédit Mutuel": ["Crédit Mutuel", "CMB", "CMSO"],
    "CIC": ["CIC"],
    "LCL": ["LCL"],
    "Crédit du Nord": ["Crédit du Nord"],
    "HSBC": ["HSBC"],
    "CCF": ["CCF"],
    "La Banque Postale": ["La Banque Postale", "Banque Postale"],
    "Crédit Coopératif": ["Crédit Coopératif"],
}
POSTAL_BRAND = "La Banque Postale"

# Terms of closure, postal points, banking services and staff matters, folded.
CLOSURE_TERMS = ["fermeture", "ferme", "fermer", "fusion", "regroupe", "supprime", "suppression", "transfert", "rideau", "cesse", "cessation", "rattach", "reorganis", "libre-service", "libre service", "n'accueillera", "quittera la commune", "quitte la commune", "transformation", "transforme en", "transformee en", "devient une agence postale", "remplace par", "remplacee par", "relais poste", "relais postal"]
POSTAL_POINTS = ["bureau de poste", "bureaux de poste", "guichet postal", "point de contact postal", "point postal", "la poste"]
POSTAL_PARTNERS = ["agence postale communale", "relais poste", "relais postal"]
POSTAL_CONVERSIONS = ["transforme en", "transformee en", "transformation en", "devient une agence postale", "remplace par", "remplacee par", "converti en", "convertie en"]
POSTAL_BANKING = ["banque postale", "services financiers", "service bancaire", "services bancaires", "conseiller bancaire", "conseillers bancaires", "gestion de comptes", "retrait d'especes", "depot d'especes", "depots d'especes"]
STAFF_TERMS = ["licenciement", "plan social", "pse", "suppression de postes", "emplois", "syndicat", "greve", "salaries"]
BRANCH_TERM = "agence"
FULL_OFFICE = "bureau de poste"

# Months of French dates, folded.
MONTHS = ["janvier", "fevrier", "mars", "avril", "mai", "juin", "juillet", "aout", "septembre", "octobre", "novembre", "decembre"]

# Departments and their codes.
DEPARTMENTS: dict[str, str] = {
    "01": "Ain", "02": "Aisne", "03": "Allier", "04": "Alpes-de-Haute-Provence", "05": "Hautes-Alpes", "06": "Alpes-Maritimes", "07": "Ardèche", "08": "Ardennes", "09": "Ariège", "10": "Aube",
    "11": "Aude", "12": "Aveyron", "13": "Bouches-du-Rhône", "14": "Calvados", "15": "Cantal", "16": "Charente", "17": "Charente-Maritime", "18": "Cher", "19": "Corrèze", "2A": "Corse-du-Sud", "2B": "Haute-Corse",
    "21": "Côte-d'Or", "22": "Côtes-d'Armor", "23": "Creuse", "24": "Dordogne", "25": "Doubs", "26": "Drôme", "27": "Eure", "28": "Eure-et-Loir", "29": "Finistère", "30": "Gard", "31": "Haute-Garonne",
    "32": "Gers", "33": "Gironde", "34": "Hérault", "35": "Ille-et-Vilaine", "36": "Indre", "37": "Indre-et-Loire", "38": "Isère", "39": "Jura", "40": "Landes", "41": "Loir-et-Cher", "42": "Loire",
    "43": "Haute-Loire", "44": "Loire-Atlantique", "45": "Loiret", "46": "Lot", "47": "Lot-et-Garonne", "48": "Lozère", "49": "Maine-et-Loire", "50": "Manche", "51": "Marne", "52": "Haute-Marne", "53": "Mayenne",
    "54": "Meurthe-et-Moselle", "55": "Meuse", "56": "Morbihan", "57": "Moselle", "58": "Nièvre", "59": "Nord", "60": "Oise", "61": "Orne", "62": "Pas-de-Calais", "63": "Puy-de-Dôme", "64": "Pyrénées-Atlantiques",
    "65": "Hautes-Pyrénées", "66": "Pyrénées-Orientales", "67": "Bas-Rhin", "68": "Haut-Rhin", "69": "Rhône", "70": "Haute-Saône", "71": "Saône-et-Loire", "72": "Sarthe", "73": "Savoie", "74": "Haute-Savoie", "75": "Paris",
    "76": "Seine-Maritime", "77": "Seine-et-Marne", "78": "Yvelines", "79": "Deux-Sèvres", "80": "Somme", "81": "Tarn", "82": "Tarn-et-Garonne", "83": "Var", "84": "Vaucluse", "85": "Vendée", "86": "Vienne",
    "87": "Haute-Vienne", "88": "Vosges", "89": "Yonne", "90": "Territoire de Belfort", "91": "Essonne", "92": "Hauts-de-Seine", "93": "Seine-Saint-Denis", "94": "Val-de-Marne", "95": "Val-d'Oise",
    "971": "Guadeloupe", "972": "Martinique", "973": "Guyane", "974": "La Réunion", "976": "Mayotte",
}


@dataclass(frozen=True)
class Lexicon:
    """The vocabularies of one triage; terms are matched in folded text, as substrings unless ``whole_words``."""

    brands: dict[str, list[str]] = field(default_factory=lambda: BRANDS)
    closure: list[str] = field(default_factory=lambda: CLOSURE_TERMS)
    points: list[str] = field(default_factory=lambda: POSTAL_POINTS)
    partners: list[str] = field(default_factory=lambda: POSTAL_PARTNERS)
    conversions: list[str] = field(default_factory=lambda: POSTAL_CONVERSIONS)
    banking: list[str] = field(default_factory=lambda: POSTAL_BANKING)
    staff: list[str] = field(default_factory=lambda: STAFF_TERMS)
    branch: str = BRANCH_TERM
    full_office: str = FULL_OFFICE
    postal_brand: str = POSTAL_BRAND
    whole_words: bool = False
