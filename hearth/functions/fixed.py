"""Fixed values.

These must equal the source programme's values for results to match: the
in-scope spellings, codes, labels, thresholds and keyword lists below are
domain constants, written out plainly and in their natural order.
"""

# --- fixed values: certificate scope -------------------------------------
SOCIAL_TENURES = ("RENTAL (SOCIAL)", "SOCIAL RENTED", "RENTED (SOCIAL)")
TARGET_REGION = "E12000007"
LETTINGS_REGION_CODES = ("7", "E12000007")
BELOW_C_RATINGS = ("D", "E", "F", "G")
AREA_CODE_PREFIX = "E09"

# --- fixed values: fuel categories (label -> category) -------------------
GAS_INDIVIDUAL = ("mains gas (not community)", "Gas: mains gas")
GAS_COMMUNITY = "mains gas (community)"
ELECTRIC_INDIVIDUAL = ("electricity (not community)",
                       "Electricity: electricity, unspecified tariff")
ELECTRIC_COMMUNITY = "electricity (community)"

# --- fixed values: construction age bands --------------------------------
PRE_1950_BANDS = (
    "England and Wales: before 1900",
    "England and Wales: 1900-1929",
    "England and Wales: 1930-1949",
)
AGE_GROUPS = {
    "England and Wales: before 1900": "Pre-1919",
    "England and Wales: 1900-1929": "Pre-1919",
    "England and Wales: 1930-1949": "1930–1949",
    "England and Wales: 1950-1966": "1950–1966",
    "England and Wales: 1967-1975": "1967–1983",
    "England and Wales: 1976-1982": "1967–1983",
    "England and Wales: 1983-1990": "1967–1983",
    "England and Wales: 1991-1995": "1991–2006",
    "England and Wales: 1996-2002": "1991–2006",
    "England and Wales: 2003-2006": "1991–2006",
    "England and Wales: 2007-2011": "2007+",
    "England and Wales: 2012 onwards": "2007+",
}
AGE_ORDER = ("Pre-1919", "1930–1949", "1950–1966", "1967–1983", "1991–2006", "2007+")
UNKNOWN = "Unknown"

# --- fixed values: band parsing ------------------------------------------
BAND_SENTINELS = ("", "Missing", "MISSING", "R", "NULL", "N/A", "No", "Yes", "Refused")
NUMBER_PATTERN = r"[\d,]+"

# --- fixed values: improvement categories, first match wins --------------
CATEGORY_KEYWORDS = (
    ("Insulation", ("wall insulation", "loft insulation", "floor insulation",
                    "roof insulation", "room-in-roof", "flat roof", "party wall")),
    ("Heating system", ("boiler", "heating unit", "warm air", "storage heater",
                        "heat pump", "biomass", "wood pellet", "room heater")),
    ("Heating controls", ("heating control", "zone control", "thermostat", "programmer",
                          "time and temperature")),
    ("Glazing & draughts", ("glazing", "double glaz", "secondary glaz", "draught", "door")),
    ("Hot water cylinder", ("hot water cylinder", "cylinder insulation", "cylinder jacket",
                            "cylinder thermostat", "immersion")),
    ("Renewables", ("solar", "photovoltaic", "wind turbine", "heat recovery")),
    ("Lighting", ("lighting",)),
)
OTHER_CATEGORY = "Other"

# --- fixed values: thresholds --------------------------------------------
TARGET_SCORE = 69            # minimum score of rating band C
EXEMPT_CAP = 10_000          # cost cap per property
QUICK_WIN_MAX = 1000         # midpoint at or below = quick win
CAVITY_WALL_ID = 6
SOLID_WALL_ID = 7
MIN_TYPE_FREQ = 500          # rows per improvement type to become a feature
MIN_PRESENT_ROWS = 30        # attribution sample rows per feature
TREND_YEARS = (2012, 2024)
TOP_AREAS = 5

QUICK_WIN = "Quick win"
MAJOR_WORKS = "Major works"

PROPERTY_CLASSES = (
    "Cannot reach C (structural — exemption likely)",
    "Can reach C — no recommendations on record",
    "Can reach C — model could not cover assessed gap",
    "Can reach C — over £10k cap",
    "Can reach C — within £10k cap",
)

# --- fixed values: region code -> name ------------------------------------
REGION_NAMES = {
    "E12000001": "North East",
    "E12000002": "North West",
    "E12000003": "Yorkshire and The Humber",
    "E12000004": "East Midlands",
    "E12000005": "West Midlands",
    "E12000006": "East of England",
    "E12000007": "London",
    "E12000008": "South East",
    "E12000009": "South West",
    "W99999999": "Wales",
    "L99999999": "Channel Islands",
    "M99999999": "Isle of Man",
    "N99999999": "Northern Ireland",
    "S99999999": "Scotland",
}
