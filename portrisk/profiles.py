"""Domain configuration: location sets, themes, thresholds.

Everything here is a fixed value: results only match if these stay as they are.
"""

# --- fixed values: location codes per route -------------------------------
TRANS_PACIFIC = ("CA02", "CA10", "USCA", "CH23", "CH30", "CH02", "JA40", "JA19", "JA01")
TRANS_ATLANTIC = ("UKF2", "UKN5", "GM04", "GM03", "SP51", "SP60", "USNY", "USGA", "USFL", "CA10", "CA07")
CAPE_ROUTE = ()  # no locations assigned yet, so its flag is always 0

# --- fixed values: report columns, one 0/1 flag per route ------------------
ROUTE_FLAGS = {
    "is_ruta_transpacifica": TRANS_PACIFIC,
    "is_ruta_transatlantica": TRANS_ATLANTIC,
    "is_ruta_del_cabo_de_buena_esperanza": CAPE_ROUTE,
}

# --- fixed values: forecast profiles (named sets of location codes) --------
PROFILES = {
    "trans_pacific": TRANS_PACIFIC,
    "trans_atlantic": TRANS_ATLANTIC,
    "CA02": ("CA02",),
    "CA10": ("CA10",),
    "USCA": ("USCA",),
    "CH02": ("CH02",),
    "CH23": ("CH23",),
    "CH30": ("CH30",),
}

# --- fixed values: window length per profile (days of history) -------------
DEFAULT_LAGS = 7
LAGS = {"trans_atlantic": 8}

# --- fixed values: country sets and event root codes -----------------------
PACIFIC_COUNTRIES = ("US", "CA", "VM", "CH", "JA", "HK", "KS")
DISRUPTIVE_ROOTS = (14, 15, 16, 17, 19, 20, 21, 22)

# --- fixed values: theme words --------------------------------------------
RISK_THEMES = {
    "NewsWithTINFA": "TRANSPORT_INFRASTRUCTURE",
    "NewsWithTRADE": "TRADE",
    "NewsWithME": "MACROECONOMIC",
    "NewsWithPS": "PUBLIC_SECTOR",
    "NewsWithMI": "MARITIME_INCIDENT",
}
DISRUPTION_THEMES = {
    "NewsAboutDisruption": "DISRUPTION",
    "NewsAboutStrikes": "STRIKES",
    "NewsAboutProtest": "PROTEST",
    "NewsAboutMaritimeDisaster": "MARITIME_DISASTER",
    "NewsAboutTerrorism": "TERRORISM",
    "NewsAboutPiracy": "PIRACY",
    "NewsAboutCongestion": "CONGESTION",
}
# daily count column for each disruption flag
DISRUPTION_COUNTS = {
    "NewsAboutDisruption": "DisruptionNews",
    "NewsAboutStrikes": "StrikeNews",
    "NewsAboutProtest": "ProtestNews",
    "NewsAboutMaritimeDisaster": "MDNews",
    "NewsAboutTerrorism": "TerrorismNews",
    "NewsAboutPiracy": "PiracyNews",
    "NewsAboutCongestion": "CongestionNews",
}
# PORT also covers TRANSPORT, TRADE_PORT, NAVAL_PORT and LOGISTICS_PORT
PORT_WORDS = ("PORT", "SHIPPING", "MARITIME")
EXCLUDED_WORD = "AIRPORT"

# --- fixed values: thresholds and weights ----------------------------------
NEUTRAL_BAND = 0.5
HIGH_POLARITY = 9.0
WEIGHT_TOTAL_5 = 500
WEIGHT_TOTAL_4 = 250
WEIGHT_THREE = 100
WEIGHT_TOTAL_2 = 5
WINSOR_LOW, WINSOR_HIGH = 0.02, 0.99
SPLIT_DATE = "2024-01-01"
PORT_RADIUS_KM = 25.0
EARTH_RADIUS_KM = 6371.0
BAD_COORDINATE = 999.999
VANCOUVER = (49.17, -123.07)
SUMMARY_SLICE = (200, 3500)
SCRAPE_ERRORS = ("Client Error", "OK XID")

# --- fixed values: feature order of the daily frame (Diff is last) ---------
TONE_FEATURES = ("NegativeNews", "ToneNegativeScore", "Polarity", "MaxToneNeg", "MinToneNeg")
FEATURES = TONE_FEATURES + tuple(DISRUPTION_COUNTS.values()) + ("Diff",)

# --- fixed values: identity of a news row -----------------------------------
NEWS_KEY = (
    "DATE", "NUMARTS", "CAMEOEVENTIDS", "THEMES", "TONE",
    "LOCATIONS", "PERSONS", "ORGANIZATIONS", "SOURCES", "SOURCEURLS",
)
URL_SEPARATOR = "<UDIV>"


def all_route_locations() -> tuple[str, ...]:
    """Every location code that belongs to at least one route, in route order."""
    return tuple(dict.fromkeys(code for codes in ROUTE_FLAGS.values() for code in codes))


def lags_for(profile: str) -> int:
    return LAGS.get(profile, DEFAULT_LAGS)
