"""Codes, labels, title and country tables, yearly exchange rates.

Everything here is plain data that results depend on.  The tables are small and
of fixed size, so operators may ship them to every executor.
"""

from __future__ import annotations

# --- Salary table contract (fixed values) ------------------------------------

SALARY_COLUMNS = (
    "work_year",
    "experience_level",
    "employment_type",
    "job_title",
    "salary",
    "salary_currency",
    "salary_in_usd",
    "employee_residence",
    "remote_ratio",
    "company_location",
    "company_size",
)

# --- Codes and labels (fixed values) -----------------------------------------

EMPLOYMENT_LABELS = {
    "FT": "Full-time",
    "PT": "Part-time",
    "CT": "Contract",
    "FL": "Freelance",
}
EMPLOYMENT_TYPES = tuple(EMPLOYMENT_LABELS.values())

COMPANY_SIZES = ("S", "M", "L")
COMPANY_SIZE_LABELS = {"S": "Small", "M": "Medium", "L": "Large"}

EXPERIENCE_LEVELS = ("EN", "MI", "SE", "EX")
EXPERIENCE_LABELS = {
    "EN": "Entry-level",
    "MI": "Mid-level",
    "SE": "Senior-level",
    "EX": "Executive-level",
}

REMOTE_RATIOS = (0, 50, 100)

# --- Job titles by bucket (fixed values) -------------------------------------

JOB_TITLES_BY_BUCKET = {
    "Analyst": [
        "Data Analyst",
        "Business Data Analyst",
        "BI Data Analyst",
        "Product Data Analyst",
        "Marketing Data Analyst",
        "Finance Data Analyst",
        "Financial Data Analyst",
        "Compliance Data Analyst",
        "Data Quality Analyst",
        "Insight Analyst",
        "BI Analyst",
        "Data Operations Analyst",
    ],
    "Data Engineer": [
        "Data Engineer",
        "Big Data Engineer",
        "Machine Learning Infrastructure Engineer",
        "Marketing Data Engineer",
        "Cloud Data Engineer",
        "Data Analytics Engineer",
        "Data Science Engineer",
        "BI Data Engineer",
        "Data Infrastructure Engineer",
        "ETL Engineer",
        "ETL Developer",
        "Software Data Engineer",
        "Azure Data Engineer",
        "Data DevOps Engineer",
        "Cloud Database Engineer",
        "Analytics Engineer",
    ],
    "Data Scientist": [
        "Data Scientist",
        "Applied Data Scientist",
        "Product Data Scientist",
        "Machine Learning Scientist",
        "Applied Machine Learning Scientist",
        "AI Scientist",
    ],
    "ML Engineer": [
        "Machine Learning Engineer",
        "ML Engineer",
        "Computer Vision Engineer",
        "Machine Learning Developer",
        "Machine Learning Research Engineer",
        "Computer Vision Software Engineer",
        "NLP Engineer",
        "Deep Learning Engineer",
        "Applied Machine Learning Engineer",
        "Machine Learning Software Engineer",
        "MLOps Engineer",
    ],
    "Research": [
        "Research Scientist",
        "Research Engineer",
        "Machine Learning Researcher",
        "3D Computer Vision Researcher",
        "Deep Learning Researcher",
        "Applied Scientist",
    ],
    "Architecture": [
        "Data Architect",
        "Big Data Architect",
        "Cloud Data Architect",
        "Data Modeler",
        "Principal Data Architect",
    ],
    "Management": [
        "Director of Data Science",
        "Data Science Manager",
        "Machine Learning Manager",
        "Head of Data Science",
        "Head of Data",
        "Head of Machine Learning",
        "Data Science Lead",
        "Data Scientist Lead",
        "Data Analytics Manager",
        "Data Manager",
        "Manager Data Management",
        "Data Lead",
    ],
    "Consulting": [
        "Data Science Consultant",
        "Data Analytics Consultant",
        "Data Strategist",
    ],
    "BI Developer": [
        "Power BI Developer",
        "BI Developer",
        "Business Intelligence Engineer",
    ],
    "AI Developer": [
        "AI Developer",
        "AI Programmer",
    ],
    "Senior": [
        "Staff Data Analyst",
        "Lead Data Analyst",
        "Lead Data Engineer",
        "Lead Data Scientist",
        "Lead Machine Learning Engineer",
        "Staff Data Scientist",
        "Principal Data Scientist",
        "Principal Data Analyst",
        "Principal Data Engineer",
        "Principal Machine Learning Engineer",
        "Data Science Tech Lead",
        "Data Analytics Lead",
    ],
    "Specialist": [
        "Data Specialist",
        "Data Analytics Specialist",
        "Data Management Specialist",
        "Autonomous Vehicle Technician",
    ],
    "Operations": [
        "Data Operations Engineer",
    ],
}
JOB_TITLE_BUCKETS = {
    title: bucket for bucket, titles in JOB_TITLES_BY_BUCKET.items() for title in titles
}

# --- Countries (fixed values) ------------------------------------------------
# ISO 3166 two-letter codes by region; Honduras is known but has no region.

ISO2_BY_REGION = {
    "Europe": (
        "AL", "AT", "BA", "BE", "BG", "BY", "CH", "CY", "CZ", "DE",
        "DK", "EE", "ES", "FI", "FR", "GB", "GR", "HR", "HU", "IE",
        "IS", "IT", "JE", "LT", "LU", "LV", "MD", "MK", "MT", "NL",
        "NO", "PL", "PT", "RO", "RS", "RU", "SE", "SI", "SK", "UA",
        "XK",
    ),
    "South America": (
        "AR", "BO", "BR", "CL", "CO", "EC", "PE", "UY", "VE",
    ),
    "North America": (
        "BS", "BZ", "CA", "CR", "DO", "MX", "PA", "PR", "US",
    ),
    "Africa": (
        "CF", "CI", "CM", "CV", "DZ", "EG", "ET", "GH", "KE", "MA",
        "NG", "SN", "TN", "TZ", "UG", "ZA",
    ),
    "Asia": (
        "AE", "AM", "BD", "CN", "HK", "ID", "IL", "IN", "IQ", "IR",
        "JP", "KP", "KR", "KW", "KZ", "LA", "MY", "PH", "PK", "QA",
        "SA", "SG", "TH", "TR", "TW", "UZ", "VN",
    ),
    "Oceania": (
        "AS", "AU", "NZ",
    ),
}
ISO2_WITHOUT_REGION = ("HN",)

# ISO 3166 three-letter code -> two-letter code.
ISO3_TO_ISO2 = {
    "ALB": "AL", "ARE": "AE", "ARG": "AR", "ARM": "AM", "ASM": "AS", "AUS": "AU",
    "AUT": "AT", "BEL": "BE", "BHS": "BS", "BIH": "BA", "BOL": "BO", "BRA": "BR",
    "CAF": "CF", "CAN": "CA", "CHE": "CH", "CHL": "CL", "CHN": "CN", "COL": "CO",
    "CRI": "CR", "CYP": "CY", "CZE": "CZ", "DEU": "DE", "DNK": "DK", "DOM": "DO",
    "DZA": "DZ", "EGY": "EG", "ESP": "ES", "EST": "EE", "FIN": "FI", "FRA": "FR",
    "GBR": "GB", "GHA": "GH", "GRC": "GR", "HKG": "HK", "HND": "HN", "HRV": "HR",
    "HUN": "HU", "IDN": "ID", "IND": "IN", "IRL": "IE", "IRN": "IR", "IRQ": "IQ",
    "ISR": "IL", "ITA": "IT", "JEY": "JE", "JPN": "JP", "KEN": "KE", "KWT": "KW",
    "LTU": "LT", "LUX": "LU", "LVA": "LV", "MAR": "MA", "MDA": "MD", "MEX": "MX",
    "MKD": "MK", "MLT": "MT", "MYS": "MY", "NGA": "NG", "NLD": "NL", "NZL": "NZ",
    "PAK": "PK", "PHL": "PH", "POL": "PL", "PRI": "PR", "PRT": "PT", "ROU": "RO",
    "RUS": "RU", "SGP": "SG", "SRB": "RS", "SVK": "SK", "SVN": "SI", "SWE": "SE",
    "THA": "TH", "TUN": "TN", "TUR": "TR", "UKR": "UA", "USA": "US", "UZB": "UZ",
    "VNM": "VN", "XKX": "XK", "ZAF": "ZA",
}

# Country names and informal codes -> two-letter code.
COUNTRY_NAME_TO_ISO2 = {
    "BOLIVIA": "BO",
    "BOSNIA AND HERZEGOVINA": "BA",
    "CAPE VERDE": "CV",
    "CZECH REPUBLIC": "CZ",
    "CZECHIA": "CZ",
    "CÔTE D'IVOIRE": "CI",
    "EL": "GR",
    "ENGLAND": "GB",
    "FRANCE": "FR",
    "GREAT BRITAIN": "GB",
    "HONG KONG": "HK",
    "IVORY COAST": "CI",
    "KO": "XK",
    "LAO PDR": "LA",
    "LAOS": "LA",
    "MACEDONIA": "MK",
    "MOLDOVA": "MD",
    "NORTH KOREA": "KP",
    "NORTH MACEDONIA": "MK",
    "REPUBLIC OF KOREA": "KR",
    "REPUBLIC OF MOLDOVA": "MD",
    "RUSSIA": "RU",
    "SAUDI ARABIA": "SA",
    "SOUTH AFRICA": "ZA",
    "SOUTH KOREA": "KR",
    "TAIWAN": "TW",
    "TURKEY": "TR",
    "TÜRKIYE": "TR",
    "UAE": "AE",
    "UK": "GB",
    "UNITED ARAB EMIRATES": "AE",
    "UNITED KINGDOM": "GB",
    "UNITED STATES": "US",
    "VIET NAM": "VN",
    "VIETNAM": "VN",
}

REGION_BY_ISO2 = {
    code: region for region, codes in ISO2_BY_REGION.items() for code in codes
}
# Two-letter codes stand for themselves; ISO3 codes and names are added to them.
COUNTRY_TO_ISO2 = {
    **{code: code for code in (*REGION_BY_ISO2, *ISO2_WITHOUT_REGION)},
    **ISO3_TO_ISO2,
    **COUNTRY_NAME_TO_ISO2,
}

# --- Exchange rates: USD per unit, by year (fixed values) ---------------------

RATE_YEARS = (2020, 2021, 2022, 2023)
RATES_BY_CURRENCY = {
    # currency: (2020, 2021, 2022, 2023)
    "AUD": (0.65, 0.70, 0.68, 0.66),
    "BRL": (0.18, 0.19, 0.20, 0.21),
    "CAD": (0.75, 0.79, 0.78, 0.77),
    "CHF": (1.10, 1.12, 1.14, 1.15),
    "CLP": (0.0013, 0.0014, 0.0013, 0.0013),
    "CZK": (0.043, 0.045, 0.046, 0.045),
    "DKK": (0.16, 0.15, 0.15, 0.16),
    "EUR": (0.88, 0.85, 0.95, 0.92),
    "GBP": (0.75, 0.73, 0.76, 0.75),
    "HKD": (0.13, 0.13, 0.13, 0.13),
    "HUF": (0.0028, 0.0029, 0.0025, 0.0027),
    "ILS": (0.28, 0.28, 0.29, 0.28),
    "INR": (0.013, 0.012, 0.012, 0.012),
    "JPY": (0.0095, 0.0091, 0.0076, 0.00822),
    "MXN": (0.053, 0.055, 0.054, 0.053),
    "NOK": (0.11, 0.12, 0.11, 0.12),
    "SGD": (0.72, 0.74, 0.73, 0.72),
    "THB": (0.029, 0.030, 0.031, 0.029),
    "TRY": (0.029, 0.028, 0.030, 0.029),
    "USD": (1.00, 1.00, 1.00, 1.00),
    "AED": (0.27, 0.27, 0.27, 0.27),
    "ARS": (0.014, 0.010, 0.0074, 0.0028),
    "BGN": (0.58, 0.57, 0.54, 0.53),
    "CNY": (0.14, 0.15, 0.14, 0.14),
    "COP": (0.00047, 0.00049, 0.00048, 0.00046),
    "EGP": (0.032, 0.031, 0.050, 0.032),
    "IDR": (0.000069, 0.000070, 0.000064, 0.000065),
    "KRW": (0.00083, 0.00085, 0.00078, 0.00076),
    "MAD": (0.11, 0.11, 0.10, 0.10),
    "MYR": (0.24, 0.24, 0.22, 0.21),
    "NZD": (0.64, 0.68, 0.62, 0.61),
    "PHP": (0.021, 0.020, 0.018, 0.018),
    "PKR": (0.0061, 0.0059, 0.0057, 0.0056),
    "PLN": (0.26, 0.24, 0.22, 0.23),
    "RON": (0.23, 0.22, 0.20, 0.21),
    "RUB": (0.013, 0.014, 0.017, 0.011),
    "SAR": (0.27, 0.27, 0.27, 0.27),
    "SEK": (0.11, 0.12, 0.10, 0.10),
    "TWD": (0.033, 0.036, 0.033, 0.032),
    "VND": (0.000043, 0.000044, 0.000042, 0.000041),
    "ZAR": (0.063, 0.065, 0.058, 0.053),
}
EXCHANGE_RATES = [
    (year, currency, rates[i])
    for i, year in enumerate(RATE_YEARS)
    for currency, rates in RATES_BY_CURRENCY.items()
]
