"""Fixed values.

These must equal the source system's values for the results to be right
(dimension contents and the airline lookup).  They are listed plainly, in
their natural order.
"""

# --- fixed values: airports (airport_id, airport_code, city, country) ---
AIRPORTS = [
    (1, "MOW", "Moscow", "Russia"),
    (2, "LED", "Saint Petersburg", "Russia"),
    (3, "AER", "Sochi", "Russia"),
    (4, "OVB", "Novosibirsk", "Russia"),
    (5, "KRR", "Krasnodar", "Russia"),
    (6, "GOJ", "Nizhny Novgorod", "Russia"),
    (7, "SVX", "Yekaterinburg", "Russia"),
    (8, "IST", "Istanbul", "Turkey"),
    (9, "TBS", "Tbilisi", "Georgia"),
    (10, "VKO", "Moscow", "Russia"),
    (11, "DME", "Moscow", "Russia"),
]

# --- fixed values: flight types (flight_type_id, transfers_count, type_category, description) ---
FLIGHT_TYPES = [
    (1, 0, "direct", "Прямой рейс без пересадок"),
    (2, 1, "one_stop", "Рейс с одной пересадкой"),
    (3, 2, "multi_stop", "Рейс с двумя и более пересадками"),
]

# --- fixed values: airline snapshot dimension (airline_id, airline_code, airline_name, country) ---
AIRLINE_SNAPSHOT = [
    (1, "SU", "Aeroflot", "Russia"),
    (2, "S7", "S7 Airlines", "Russia"),
    (3, "U6", "Ural Airlines", "Russia"),
    (4, "FV", "Rossiya Airlines", "Russia"),
    (5, "TK", "Turkish Airlines", "Turkey"),
    (6, "DP", "Pobeda", "Russia"),
    (7, "A4", "Azimuth", "Russia"),
    (8, "UT", "UTair", "Russia"),
    (9, "N4", "Nordwind", "Russia"),
    (10, "7R", "Russkie Krylya", "Russia"),
]

# --- fixed values: airline code lookup (code, name, country); unknown codes
# map to (code, 'Unknown') ---
AIRLINE_LOOKUP = [
    ("SU", "Aeroflot", "Russia"),
    ("S7", "S7 Airlines", "Russia"),
    ("U6", "Ural Airlines", "Russia"),
    ("FV", "Rossiya Airlines", "Russia"),
    ("TK", "Turkish Airlines", "Turkey"),
    ("DP", "Pobeda", "Russia"),
    ("A4", "Azimuth", "Russia"),
    ("UT", "UTair", "Russia"),
    ("N4", "Nordwind", "Russia"),
    ("7R", "Russkie Krylya", "Russia"),
    ("WZ", "Red Wings", "Russia"),
    ("5N", "Smartavia", "Russia"),
    ("D2", "Severstal Air Company", "Russia"),
    ("Y7", "Nordstar Airlines", "Russia"),
    ("6W", "Saratov Airlines", "Russia"),
    ("B2", "Belavia", "Belarus"),
    ("2S", "Southwind Airlines", "Russia"),
    ("6R", "ALROSA", "Russia"),
]
UNKNOWN_COUNTRY = "Unknown"

# --- fixed values: feed request parameters ---
GROUPED_PRICES_ORIGIN = "MOW"
GROUPED_PRICES_DESTINATIONS = ["LED", "AER", "OVB", "KRR", "GOJ", "SVX", "IST", "TBS"]
DEFAULT_CURRENCY = "rub"

# --- fixed values: bucket thresholds ---
CHEAP_PRICE_BELOW = 10000
POPULAR_PRICE_BELOW = 15000
