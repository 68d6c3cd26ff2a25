"""Fixed reference values and the expressions that look them up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "UNKNOWN"
OTHER = "Other"

# ISO 3166-1 alpha-2 country codes of each continent.
CONTINENT_COUNTRIES = {
    "EU": [
        "AL", "AD", "AT", "BY", "BE", "BA", "BG", "HR", "CY", "CZ", "DK", "EE", "FI", "FR",
        "DE", "GR", "HU", "IS", "IE", "IT", "LV", "LI", "LT", "LU", "MT", "MD", "MC", "ME",
        "NL", "MK", "NO", "PL", "PT", "RO", "RU", "SM", "RS", "SK", "SI", "ES", "SE", "CH",
        "UA", "GB", "VA",
    ],
    "NA": [
        "CA", "US", "MX", "GT", "BZ", "SV", "HN", "NI", "CR", "PA", "CU", "DO", "HT", "JM",
        "BS", "TT", "PR",
    ],
    "SA": [
        "AR", "BO", "BR", "CL", "CO", "EC", "GY", "PY", "PE", "SR", "UY", "VE",
    ],
    "AS": [
        "AF", "AM", "AZ", "BH", "BD", "BT", "BN", "KH", "CN", "GE", "IN", "ID", "IR", "IQ",
        "IL", "JP", "JO", "KZ", "KW", "KG", "LA", "LB", "MY", "MV", "MN", "MM", "NP", "KP",
        "OM", "PK", "PH", "QA", "SA", "SG", "KR", "LK", "SY", "TW", "TJ", "TH", "TR", "TM",
        "AE", "UZ", "VN", "YE", "HK", "MO",
    ],
    "AF": [
        "DZ", "AO", "BJ", "BW", "BF", "BI", "CM", "CV", "CF", "TD", "KM", "CG", "CD", "CI",
        "DJ", "EG", "GQ", "ER", "ET", "GA", "GM", "GH", "GN", "KE", "LS", "LR", "LY", "MG",
        "MW", "ML", "MR", "MU", "MA", "MZ", "NA", "NE", "NG", "RW", "SN", "SC", "SL", "SO",
        "ZA", "SS", "SD", "TZ", "TG", "TN", "UG", "ZM", "ZW",
    ],
    "OC": [
        "AU", "FJ", "KI", "NZ", "PG", "WS", "SB", "TO", "VU", "NC", "PF",
    ],
}

# Display name of each continent code.
CONTINENT_NAMES = {
    "AF": "Africa", "AN": "Antarctica", "AS": "Asia", "EU": "Europe", "NA": "North America",
    "OC": "Oceania", "SA": "South America", UNKNOWN: "Unknown",
}

# Country name and ISO code. A code may have several names.
CODE_OF_COUNTRY_NAME = {
    "Albania": "AL",
    "Andorra": "AD",
    "Austria": "AT",
    "Belarus": "BY",
    "Belgium": "BE",
    "Bosnia and Herzegovina": "BA",
    "Bulgaria": "BG",
    "Croatia": "HR",
    "Cyprus": "CY",
    "Czech Republic": "CZ",
    "Czechia": "CZ",
    "Denmark": "DK",
    "Estonia": "EE",
    "Finland": "FI",
    "France": "FR",
    "Germany": "DE",
    "Greece": "GR",
    "Hungary": "HU",
    "Iceland": "IS",
    "Ireland": "IE",
    "Italy": "IT",
    "Latvia": "LV",
    "Liechtenstein": "LI",
    "Lithuania": "LT",
    "Luxembourg": "LU",
    "Malta": "MT",
    "Moldova": "MD",
    "Monaco": "MC",
    "Montenegro": "ME",
    "Netherlands": "NL",
    "North Macedonia": "MK",
    "Macedonia": "MK",
    "Norway": "NO",
    "Poland": "PL",
    "Portugal": "PT",
    "Romania": "RO",
    "Russia": "RU",
    "Russian Federation": "RU",
    "San Marino": "SM",
    "Serbia": "RS",
    "Slovakia": "SK",
    "Slovenia": "SI",
    "Spain": "ES",
    "Sweden": "SE",
    "Switzerland": "CH",
    "Ukraine": "UA",
    "United Kingdom": "GB",
    "Canada": "CA",
    "United States": "US",
    "United States of America": "US",
    "Mexico": "MX",
    "Guatemala": "GT",
    "Belize": "BZ",
    "El Salvador": "SV",
    "Honduras": "HN",
    "Nicaragua": "NI",
    "Costa Rica": "CR",
    "Panama": "PA",
    "Cuba": "CU",
    "Dominican Republic": "DO",
    "Haiti": "HT",
    "Jamaica": "JM",
    "Bahamas": "BS",
    "Trinidad and Tobago": "TT",
    "Puerto Rico": "PR",
    "Argentina": "AR",
    "Bolivia": "BO",
    "Brazil": "BR",
    "Chile": "CL",
    "Colombia": "CO",
    "Ecuador": "EC",
    "Guyana": "GY",
    "Paraguay": "PY",
    "Peru": "PE",
    "Suriname": "SR",
    "Uruguay": "UY",
    "Venezuela": "VE",
    "Afghanistan": "AF",
    "Armenia": "AM",
    "Azerbaijan": "AZ",
    "Bahrain": "BH",
    "Bangladesh": "BD",
    "Bhutan": "BT",
    "Brunei": "BN",
    "Cambodia": "KH",
    "China": "CN",
    "Georgia": "GE",
    "India": "IN",
    "Indonesia": "ID",
    "Iran": "IR",
    "Iraq": "IQ",
    "Israel": "IL",
    "Japan": "JP",
    "Jordan": "JO",
    "Kazakhstan": "KZ",
    "Kuwait": "KW",
    "Kyrgyzstan": "KG",
    "Laos": "LA",
    "Lebanon": "LB",
    "Malaysia": "MY",
    "Maldives": "MV",
    "Mongolia": "MN",
    "Myanmar": "MM",
    "Nepal": "NP",
    "North Korea": "KP",
    "Oman": "OM",
    "Pakistan": "PK",
    "Philippines": "PH",
    "Qatar": "QA",
    "Saudi Arabia": "SA",
    "Singapore": "SG",
    "South Korea": "KR",
    "Sri Lanka": "LK",
    "Syria": "SY",
    "Taiwan": "TW",
    "Tajikistan": "TJ",
    "Thailand": "TH",
    "Turkey": "TR",
    "Turkmenistan": "TM",
    "United Arab Emirates": "AE",
    "Uzbekistan": "UZ",
    "Vietnam": "VN",
    "Yemen": "YE",
    "Hong Kong": "HK",
    "Macau": "MO",
    "Algeria": "DZ",
    "Angola": "AO",
    "Benin": "BJ",
    "Botswana": "BW",
    "Burkina Faso": "BF",
    "Burundi": "BI",
    "Cameroon": "CM",
    "Cape Verde": "CV",
    "Chad": "TD",
    "Congo": "CG",
    "Democratic Republic of the Congo": "CD",
    "Ivory Coast": "CI",
    "Djibouti": "DJ",
    "Egypt": "EG",
    "Eritrea": "ER",
    "Ethiopia": "ET",
    "Gabon": "GA",
    "Gambia": "GM",
    "Ghana": "GH",
    "Guinea": "GN",
    "Kenya": "KE",
    "Lesotho": "LS",
    "Liberia": "LR",
    "Libya": "LY",
    "Madagascar": "MG",
    "Malawi": "MW",
    "Mali": "ML",
    "Mauritania": "MR",
    "Mauritius": "MU",
    "Morocco": "MA",
    "Mozambique": "MZ",
    "Namibia": "NA",
    "Niger": "NE",
    "Nigeria": "NG",
    "Rwanda": "RW",
    "Senegal": "SN",
    "Seychelles": "SC",
    "Sierra Leone": "SL",
    "Somalia": "SO",
    "South Africa": "ZA",
    "South Sudan": "SS",
    "Sudan": "SD",
    "Tanzania": "TZ",
    "Togo": "TG",
    "Tunisia": "TN",
    "Uganda": "UG",
    "Zambia": "ZM",
    "Zimbabwe": "ZW",
    "Australia": "AU",
    "Fiji": "FJ",
    "Kiribati": "KI",
    "New Zealand": "NZ",
    "Papua New Guinea": "PG",
    "Samoa": "WS",
    "Solomon Islands": "SB",
    "Tonga": "TO",
    "Vanuatu": "VU",
    "New Caledonia": "NC",
    "French Polynesia": "PF",
}

# Aircraft type-code prefix and manufacturer. The longest prefix wins.
MANUFACTURER_PREFIXES = {
    "BCS": "Airbus", "CRJ": "Bombardier", "CL": "Bombardier", "DH": "De Havilland Canada",
    "AT": "ATR", "E1": "Embraer", "E2": "Embraer", "EMB": "Embraer", "A": "Airbus", "B": "Boeing",
    "MD": "McDonnell Douglas", "F": "Fokker", "SU": "Sukhoi", "AN": "Antonov", "IL": "Ilyushin",
    "TU": "Tupolev",
}

CONTINENT_OF_COUNTRY = {
    code: continent for continent, codes in CONTINENT_COUNTRIES.items() for code in codes
}


def name_key(name: str) -> str:
    """The spelling under which a country name is looked up: ASCII letters, lower case."""
    return "".join(ch for ch in name.lower() if "a" <= ch <= "z")


CODE_OF_NAME_KEY = {name_key(name): code for name, code in CODE_OF_COUNTRY_NAME.items()}


def _literal_map(values: dict[str, str]) -> Column:
    """A constant map, handed over as one text: Catalyst folds it when it plans the query."""
    text = ";".join(f"{key}={value}" for key, value in values.items())
    return F.str_to_map(F.lit(text), F.lit(";"), F.lit("="))


def country_code_of_name(name: Column) -> Column:
    """ISO code of a country name in display or hyphenated spelling; unknown gives NULL."""
    key = F.regexp_replace(F.lower(name), "[^a-z]", "")
    return _literal_map(CODE_OF_NAME_KEY)[key]


def continent_code(country_code: Column) -> Column:
    """Continent of an ISO code; ``UNKNOWN`` for unlisted or missing codes.

    The look-up goes continent by continent: ``isin`` over constants becomes one hashed set
    test (``InSet``) per continent, where a literal map would compare its keys one by one.
    """
    code = F.upper(country_code)
    found = F.lit(None).cast("string")
    for continent, codes in reversed(CONTINENT_COUNTRIES.items()):
        found = F.when(code.isin(codes), continent).otherwise(found)
    return F.coalesce(found, F.lit(UNKNOWN))


def continent_name(continent: Column) -> Column:
    """Display name of a continent code; unlisted codes give NULL."""
    return _literal_map(CONTINENT_NAMES)[continent]


def manufacturer(aircraft_code: Column) -> Column:
    """Manufacturer of a type code: 3, then 2, then 1 leading characters; else ``Other``."""
    code = F.upper(aircraft_code)
    by_length: dict[int, dict[str, str]] = {}
    for prefix, name in MANUFACTURER_PREFIXES.items():
        by_length.setdefault(len(prefix), {})[prefix] = name
    tiers = [
        _literal_map(by_length[size])[F.substring(code, 1, size)]
        for size in sorted(by_length, reverse=True)
    ]
    return F.coalesce(*tiers, F.lit(OTHER))
