"""Fixed values of the domain: thresholds, unit factors, code tables, zoom tables.

Everything in this module is data that results depend on.  No logic lives here.
"""

from __future__ import annotations

EVENT_TYPES = ("earthquake", "fire", "flood", "storm")
SEVERITY_LEVELS = ("LOW", "MEDIUM", "HIGH", "CRITICAL")

# --- fixed values: severity thresholds (minimum, medium, high, critical) -----
# "fmi": fire in summed MW, flood as magnitude index (adapter events).
# "cm":  fire in MW, flood as water height in centimetres (unified events).
SEVERITY_THRESHOLDS = {
    "fmi": {
        "earthquake": (1.5, 3.0, 5.0, 7.0),
        "fire": (5.0, 20.0, 50.0, 200.0),
        "flood": (0.5, 1.0, 2.0, 3.0),
        "storm": (35.0, 62.0, 120.0, 200.0),
    },
    "cm": {
        "earthquake": (1.5, 3.0, 5.0, 7.0),
        "fire": (5.0, 100.0, 2000.0, 7000.0),
        "flood": (5.0, 50.0, 200.0, 800.0),
        "storm": (35.0, 62.0, 120.0, 200.0),
    },
}
# Thresholds the severity report uses for a type it does not know.
FALLBACK_THRESHOLDS = (0.0, 1.0, 2.0, 3.0)

# --- fixed values: unit factors ----------------------------------------------
FEET_TO_CM = 30.48
FEET_TO_M = 0.3048
KNOTS_TO_KMH = 1.852
MS_TO_KMH = 3.6
KM_PER_DEGREE = 111.0

# --- fixed values: rupture area 10^(a + b * magnitude), in km2 ---------------
RUPTURE_AREA_A = -3.49
RUPTURE_AREA_B = 0.91

# --- fixed values: upper wind bounds in m/s of Beaufort 0..11; above is 12 ---
BEAUFORT_BOUNDS = (0.3, 1.6, 3.4, 5.5, 8.0, 10.8, 13.9, 17.2, 20.8, 24.5, 28.5, 32.7)

# --- fixed values: storm gate -------------------------------------------------
STORM_MIN_RAIN_1H = 2.5
STORM_MIN_WIND_MS = 10.0
THUNDER_CODES = (200, 299)

# --- fixed values: seismic network code to agency ----------------------------
NETWORK_AGENCY = {"us": "USGS", "eu": "EMSC", "jp": "JMA", "es": "IGN", "nz": "GeoNet"}
DEFAULT_AGENCY = "USGS"

# --- fixed values: fire pixel clustering -------------------------------------
FIRE_CELL_DEGREES = 0.5
FIRE_MIN_MW = 5.0
MODIS_MIN_CONFIDENCE = 30
VIIRS_CONFIDENCE_SCORE = {"l": 25, "n": 60, "h": 90}
VIIRS_DEFAULT_SCORE = 60
FALLBACK_FIRE_TIMESTAMP = "2024-01-01T00:00:00Z"

# --- fixed values: flood magnitude index -------------------------------------
FLOOD_WEIGHTS = {"area": 0.5, "depth": 0.3, "time": 0.2}
FLOOD_QUALITY = {2: "Good", 3: "Fair", 4: "Poor"}
FLOOD_USABLE_QUALITY = 3
FLOOD_MIN_MARKS = 3
FLOOD_POINT_AREA_KM2 = 1.0
FLOOD_UNKNOWN_HOURS = 24.0
FALLBACK_FLOOD_TIMESTAMP = "2024-06-01T00:00:00Z"

# --- fixed values: topic per event type --------------------------------------
TOPICS = {
    "earthquake": "earthquakes-topic",
    "fire": "fires-topic",
    "flood": "floods-topic",
    "storm": "storms-topic",
}

# --- fixed values: file name per event type ----------------------------------
FEED_FILES = {
    "earthquake": "earthquakes.json",
    "fire": "fires.json",
    "flood": "floods.json",
    "storm": "storms.json",
}

# --- fixed values: plausible severity range per type, minimum rows, span -----
SEVERITY_RANGES = {
    "earthquake": (0.0, 9.5),
    "fire": (0.0, 10000.0),
    "flood": (0.0, 2000.0),
    "storm": (0.0, 300.0),
}
MIN_EVENTS_PER_TYPE = 50
MIN_SPAN_DAYS = 30

# --- fixed values: live feed --------------------------------------------------
LIVE_WINDOW_HOURS = 8
MAP_POINT_LIMIT = 1000
MAP_MAX_CLUSTER_ZOOM = 9
MAP_FIRST_DATE = "1980-01-01"

# --- fixed values: map tables by zoom level ----------------------------------
SQUARE_CELL_DEGREES = {2: 20.0, 3: 12.0, 4: 6.0, 5: 3.0, 6: 1.5, 7: 0.75, 8: 0.3, 9: 0.1}
PRE_CELL_DEGREES = {2: 5.0, 3: 2.0, 4: 1.0, 5: 0.5, 6: 0.2, 7: 0.1, 8: 0.05, 9: 0.02}
PYRAMID_ZOOMS = range(2, 7)
HEX_RESOLUTION = {2: 2, 3: 2, 4: 2, 5: 3, 6: 3, 7: 3, 8: 4, 9: 4}
HEX_AREA_KM2 = {2: 86000.0, 3: 12000.0, 4: 1700.0, 5: 250.0}
MIN_CLUSTER_COUNT = {2: 100, 3: 50, 4: 20, 5: 5}
MAX_CLUSTERS_PER_TYPE = {2: 500, 3: 300, 4: 200, 5: 100, 6: 80, 7: 100, 8: 150, 9: 200}

# --- fixed values: yearly targets per type, by anchor year -------------------
YEARLY_TARGETS = {
    "earthquake": {1980: 740, 1990: 740, 2000: 740, 2010: 740, 2020: 740, 2025: 740},
    "flood": {1980: 820, 1990: 880, 2000: 980, 2010: 1080, 2020: 1200, 2025: 1200},
    "storm": {1980: 740, 1990: 880, 2000: 1080, 2010: 1320, 2020: 1600, 2025: 1600},
    "fire": {1980: 820, 1990: 1020, 2000: 1320, 2010: 1750, 2020: 2200, 2025: 2200},
}

# --- fixed values: country name by ISO 3166-1 alpha-2 code -------------------
COUNTRY_BY_CODE = {
    "AF": "Afghanistan",
    "AL": "Albania",
    "DZ": "Algeria",
    "AO": "Angola",
    "AR": "Argentina",
    "AM": "Armenia",
    "AU": "Australia",
    "AZ": "Azerbaijan",
    "BD": "Bangladesh",
    "BO": "Bolivia",
    "BA": "Bosnia-Herzegovina",
    "BR": "Brazil",
    "BN": "Brunei",
    "BF": "Burkina Faso",
    "BI": "Burundi",
    "KH": "Cambodia",
    "CM": "Cameroon",
    "CA": "Canada",
    "CF": "Central African Republic",
    "TD": "Chad",
    "CL": "Chile",
    "CN": "China",
    "CO": "Colombia",
    "CD": "DR Congo",
    "CG": "Republic of Congo",
    "CR": "Costa Rica",
    "CI": "Ivory Coast",
    "CU": "Cuba",
    "CY": "Cyprus",
    "DJ": "Djibouti",
    "DO": "Dominican Republic",
    "EC": "Ecuador",
    "EG": "Egypt",
    "SV": "El Salvador",
    "ER": "Eritrea",
    "ET": "Ethiopia",
    "FJ": "Fiji",
    "FR": "France",
    "GA": "Gabon",
    "GE": "Georgia",
    "DE": "Germany",
    "GH": "Ghana",
    "GR": "Greece",
    "GT": "Guatemala",
    "GN": "Guinea",
    "GW": "Guinea-Bissau",
    "HT": "Haiti",
    "HN": "Honduras",
    "HU": "Hungary",
    "IS": "Iceland",
    "IN": "India",
    "ID": "Indonesia",
    "IR": "Iran",
    "IQ": "Iraq",
    "IT": "Italy",
    "JM": "Jamaica",
    "JP": "Japan",
    "JO": "Jordan",
    "KZ": "Kazakhstan",
    "KE": "Kenya",
    "KG": "Kyrgyzstan",
    "LA": "Laos",
    "LB": "Lebanon",
    "LR": "Liberia",
    "LY": "Libya",
    "MG": "Madagascar",
    "MW": "Malawi",
    "MY": "Malaysia",
    "ML": "Mali",
    "MR": "Mauritania",
    "MX": "Mexico",
    "MN": "Mongolia",
    "MA": "Morocco",
    "MZ": "Mozambique",
    "MM": "Myanmar",
    "NA": "Namibia",
    "NP": "Nepal",
    "NZ": "New Zealand",
    "NI": "Nicaragua",
    "NE": "Niger",
    "NG": "Nigeria",
    "MK": "North Macedonia",
    "NO": "Norway",
    "OM": "Oman",
    "PK": "Pakistan",
    "PA": "Panama",
    "PG": "Papua New Guinea",
    "PY": "Paraguay",
    "PE": "Peru",
    "PH": "Philippines",
    "PL": "Poland",
    "PT": "Portugal",
    "RO": "Romania",
    "RU": "Russia",
    "RW": "Rwanda",
    "SA": "Saudi Arabia",
    "SN": "Senegal",
    "SL": "Sierra Leone",
    "SB": "Solomon Islands",
    "SO": "Somalia",
    "ZA": "South Africa",
    "SS": "South Sudan",
    "ES": "Spain",
    "LK": "Sri Lanka",
    "SD": "Sudan",
    "SR": "Suriname",
    "SY": "Syria",
    "TJ": "Tajikistan",
    "TZ": "Tanzania",
    "TH": "Thailand",
    "TL": "Timor-Leste",
    "TG": "Togo",
    "TO": "Tonga",
    "TT": "Trinidad and Tobago",
    "TN": "Tunisia",
    "TR": "Turkey",
    "TM": "Turkmenistan",
    "UG": "Uganda",
    "UA": "Ukraine",
    "AE": "United Arab Emirates",
    "GB": "United Kingdom",
    "US": "United States",
    "UY": "Uruguay",
    "UZ": "Uzbekistan",
    "VU": "Vanuatu",
    "VE": "Venezuela",
    "VN": "Vietnam",
    "YE": "Yemen",
    "ZM": "Zambia",
    "ZW": "Zimbabwe",
    "TW": "Taiwan",
    "KR": "South Korea",
    "KP": "North Korea",
    "FM": "Micronesia",
    "PW": "Palau",
    "WS": "Samoa",
    "KI": "Kiribati",
    "PF": "French Polynesia",
    "NC": "New Caledonia",
    "GU": "Guam",
}

# --- fixed values: region by country code ------------------------------------
REGION_BY_CODE = {
    "JP": "East Asia",
    "CN": "East Asia",
    "KR": "East Asia",
    "KP": "East Asia",
    "MN": "East Asia",
    "TW": "East Asia",
    "ID": "Southeast Asia",
    "PH": "Southeast Asia",
    "VN": "Southeast Asia",
    "TH": "Southeast Asia",
    "MY": "Southeast Asia",
    "MM": "Southeast Asia",
    "KH": "Southeast Asia",
    "LA": "Southeast Asia",
    "TL": "Southeast Asia",
    "BN": "Southeast Asia",
    "SG": "Southeast Asia",
    "IN": "South Asia",
    "BD": "South Asia",
    "PK": "South Asia",
    "NP": "South Asia",
    "LK": "South Asia",
    "AF": "South Asia",
    "KZ": "Central Asia",
    "UZ": "Central Asia",
    "TM": "Central Asia",
    "KG": "Central Asia",
    "TJ": "Central Asia",
    "TR": "Middle East",
    "IR": "Middle East",
    "IQ": "Middle East",
    "SY": "Middle East",
    "LB": "Middle East",
    "JO": "Middle East",
    "SA": "Middle East",
    "YE": "Middle East",
    "OM": "Middle East",
    "AE": "Middle East",
    "IL": "Middle East",
    "CY": "Middle East",
    "GE": "Caucasus",
    "AM": "Caucasus",
    "AZ": "Caucasus",
    "GR": "Southern Europe",
    "IT": "Southern Europe",
    "ES": "Southern Europe",
    "PT": "Southern Europe",
    "MK": "Southern Europe",
    "AL": "Southern Europe",
    "BA": "Southern Europe",
    "DE": "Central Europe",
    "PL": "Central Europe",
    "HU": "Central Europe",
    "RO": "Central Europe",
    "UA": "Eastern Europe",
    "GB": "Western Europe",
    "FR": "Western Europe",
    "NO": "Northern Europe",
    "IS": "Northern Europe",
    "RU": "Siberia / Russia",
    "US": "North America",
    "CA": "North America",
    "MX": "Central America",
    "GT": "Central America",
    "SV": "Central America",
    "HN": "Central America",
    "NI": "Central America",
    "CR": "Central America",
    "PA": "Central America",
    "CU": "Caribbean",
    "JM": "Caribbean",
    "HT": "Caribbean",
    "DO": "Caribbean",
    "TT": "Caribbean",
    "CO": "South America",
    "VE": "South America",
    "EC": "South America",
    "PE": "South America",
    "BR": "South America",
    "BO": "South America",
    "CL": "South America",
    "AR": "South America",
    "PY": "South America",
    "UY": "South America",
    "SR": "South America",
    "NG": "West Africa",
    "GH": "West Africa",
    "CI": "West Africa",
    "SN": "West Africa",
    "ML": "West Africa",
    "BF": "West Africa",
    "GN": "West Africa",
    "SL": "West Africa",
    "LR": "West Africa",
    "MR": "West Africa",
    "NE": "West Africa",
    "TD": "West Africa",
    "CM": "Central Africa",
    "CF": "Central Africa",
    "GA": "Central Africa",
    "CG": "Central Africa",
    "CD": "Central Africa",
    "AO": "Central Africa",
    "ET": "East Africa",
    "KE": "East Africa",
    "TZ": "East Africa",
    "UG": "East Africa",
    "RW": "East Africa",
    "BI": "East Africa",
    "SO": "East Africa",
    "DJ": "East Africa",
    "ER": "East Africa",
    "SD": "East Africa",
    "SS": "East Africa",
    "ZA": "Southern Africa",
    "MZ": "Southern Africa",
    "ZW": "Southern Africa",
    "ZM": "Southern Africa",
    "MW": "Southern Africa",
    "NA": "Southern Africa",
    "DZ": "North Africa",
    "LY": "North Africa",
    "EG": "North Africa",
    "MA": "North Africa",
    "TN": "North Africa",
    "MG": "Indian Ocean",
    "AU": "Oceania",
    "NZ": "Oceania",
    "PG": "Oceania",
    "FJ": "Oceania",
    "VU": "Oceania",
    "SB": "Oceania",
    "TO": "Oceania",
    "WS": "Oceania",
    "FM": "Oceania",
    "PW": "Oceania",
    "KI": "Oceania",
    "PF": "Oceania",
    "NC": "Oceania",
    "GU": "Oceania",
}
