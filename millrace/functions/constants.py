"""Fixed values of the text rules: word lists and replacements, in natural order."""

# French stop words dropped by the v3 profile.
FRENCH_STOP_WORDS = ["le", "la", "les", "l", "un", "une", "des", "de", "du", "d", "societe", "entreprise", "groupe", "et", "en", "pour", "par"]

# Token replacements of the v3 profile.
FRENCH_REPLACEMENTS = {"rue": "st", "blvd": "blvd", "av": "ave", "avenue": "ave", "boulevard": "blvd", "chemin": "rd", "route": "rt", "place": "pl"}

# Business suffixes that strip_suffix drops.
BUSINESS_SUFFIXES = [
    "inc", "ltd", "llc", "corp", "corporation", "limited", "company", "co", "pvt", "private", "plc", "gmbh", "ag", "sa", "srl", "bv", "nv", "spa",
    "pty", "ab", "as", "oy", "sas", "sarl", "kg", "incorporated", "holdings", "holding", "enterprises", "enterprise", "group", "international",
    "solutions", "technologies", "services",
]

# Abbreviations that expand_abbreviations spells out.
ABBREVIATIONS = {
    "intl": "international", "mfg": "manufacturing", "svcs": "services", "svc": "service", "tech": "technology", "engr": "engineering", "eng": "engineering",
    "assoc": "associates", "mgmt": "management", "dev": "development", "grp": "group", "hldg": "holding", "hldgs": "holdings", "natl": "national",
    "govt": "government", "univ": "university", "hosp": "hospital", "pharm": "pharmaceutical", "chem": "chemical", "elec": "electrical", "mech": "mechanical",
    "ind": "industries", "inds": "industries", "sys": "systems", "dist": "distribution", "trans": "transport", "telecom": "telecommunications", "info": "information",
}

# Letter codes of the phonetic key.
PHONETIC_CODES = {"BFPV": "1", "CGJKQSXZ": "2", "DT": "3", "L": "4", "MN": "5", "R": "6"}
