"""Labels, limits, word lists and texts that results must carry exactly."""

# Bands: (upper limit inclusive, label) in ascending order.
DURATION_BANDS = [(2, "SHORT_HAUL"), (6, "MEDIUM_HAUL"), (12, "LONG_HAUL")]
DURATION_ABOVE = "ULTRA_LONG_HAUL"
LEAD_BANDS = [(1, "LAST_MINUTE"), (7, "SHORT_NOTICE"), (30, "ADVANCE")]
LEAD_ABOVE = "EARLY_BOOKING"
PRICE_BANDS = [(200, "BUDGET"), (500, "MODERATE"), (1000, "PREMIUM")]
PRICE_ABOVE = "LUXURY"
SIGHTING_BANDS = [
    (60, "VERY SHORT (≤1 min)"),
    (300, "SHORT (1-5 min)"),
    (1800, "MEDIUM (5-30 min)"),
    (3600, "LONG (30min-1hr)"),
]
SIGHTING_ABOVE = "VERY LONG (>1hr)"

# Bands: (upper limit exclusive, label) in ascending order.
WIND_BANDS = [(12, "CALM"), (25, "LIGHT"), (39, "MODERATE"), (62, "STRONG")]
WIND_ABOVE = "VERY_STRONG"
ERA_BANDS = [
    (1950, "EARLY_AVIATION"),
    (1970, "JET_AGE_EARLY"),
    (1990, "JET_AGE_MATURE"),
    (2010, "MODERN_AVIATION"),
]
ERA_ABOVE = "CONTEMPORARY"

# Floors: (lower limit inclusive, label) in descending order.
VISIBILITY_FLOORS = [(10, "EXCELLENT"), (5, "GOOD"), (1.5, "MODERATE"), (0.8, "POOR")]
VISIBILITY_BELOW = "VERY_POOR"
CITY_FLOORS = [
    (100, "VERY HIGH ACTIVITY"),
    (50, "HIGH ACTIVITY"),
    (20, "MEDIUM ACTIVITY"),
    (5, "LOW ACTIVITY"),
]
CITY_BELOW = "MINIMAL ACTIVITY"
COUNTRY_FLOORS = [(1000, "VERY HIGH"), (500, "HIGH"), (100, "MEDIUM"), (20, "LOW")]
COUNTRY_BELOW = "MINIMAL"
AIRLINE_FLOORS = [
    (1000, "MAJOR_AIRLINE"),
    (500, "LARGE_AIRLINE"),
    (100, "MEDIUM_AIRLINE"),
    (50, "SMALL_AIRLINE"),
]
AIRLINE_BELOW = "MICRO_AIRLINE"
ROUTE_FLOORS = [
    (1000, "VERY_HIGH_VOLUME"),
    (500, "HIGH_VOLUME"),
    (100, "MEDIUM_VOLUME"),
    (50, "LOW_VOLUME"),
]
ROUTE_BELOW = "VERY_LOW_VOLUME"
SEVERITY_FLOORS = [(6, "EXTREME"), (4, "SEVERE"), (2, "MODERATE"), (1, "MILD")]
SEVERITY_BELOW = "GOOD"
MEDIA_LABELS = [(100, "HIGH_MEDIA"), (20, "MODERATE_MEDIA"), (0, "LOW_MEDIA")]
MEDIA_NONE = "MINIMAL_MEDIA"

# Closed ranges: (low, high, label).
CASUALTY_RANGES = [
    (0, 0, "NO_FATALITIES"),
    (1, 5, "LOW_CASUALTIES"),
    (6, 50, "MODERATE_CASUALTIES"),
    (51, 200, "HIGH_CASUALTIES"),
]
CASUALTY_ABOVE = (200, "MASS_CASUALTY")
DAYTIME_RANGES = [
    (5, 11, "MORNING"),
    (12, 17, "AFTERNOON"),
    (18, 21, "EVENING"),
    (22, 23, "NIGHT"),
    (0, 4, "NIGHT"),
]

# Words looked for in upper-cased text, first match wins.
WEATHER_WORDS = [
    ("CLEAR", ["CLEAR", "SUNNY"]),
    ("CLOUDY", ["CLOUD", "OVERCAST"]),
    ("RAINY", ["RAIN", "DRIZZLE"]),
    ("SNOWY", ["SNOW", "SLEET"]),
    ("FOGGY", ["FOG", "MIST"]),
    ("STORMY", ["STORM", "THUNDER"]),
    ("WINDY", ["WIND"]),
]
CLASS_WORDS = [
    ("ECONOMY", ["ECONOMY", "COACH"]),
    ("BUSINESS", ["BUSINESS"]),
    ("FIRST", ["FIRST"]),
    ("PREMIUM_ECONOMY", ["PREMIUM"]),
]
AIRLINE_WORDS = [
    ("US_MAJOR", ["AMERICAN", "DELTA", "UNITED", "SOUTHWEST"]),
    ("EUROPEAN", ["LUFTHANSA", "AIR FRANCE", "BRITISH", "KLM"]),
    ("MIDDLE_EAST", ["EMIRATES", "QATAR", "ETIHAD"]),
    ("ASIAN", ["SINGAPORE", "CATHAY", "ANA", "JAL"]),
]
MANUFACTURER_WORDS = [
    ("BOEING", ["BOEING", "B-"]),
    ("AIRBUS", ["AIRBUS", "A-"]),
    ("DOUGLAS", ["DOUGLAS", "DC-", "MD-"]),
    ("CESSNA", ["CESSNA"]),
    ("PIPER", ["PIPER"]),
    ("LOCKHEED", ["LOCKHEED"]),
    ("MILITARY", ["MILITARY", "FIGHTER"]),
]
OPERATOR_WORDS = [
    ("MILITARY", ["MILITARY", "AIR FORCE", "NAVY", "ARMY"]),
    ("PRIVATE", ["PRIVATE", "PERSONAL"]),
    ("CARGO", ["CARGO", "FREIGHT"]),
    ("CHARTER", ["CHARTER"]),
]
WEATHER_CAUSE_WORDS = ["WEATHER", "STORM", "WIND", "RAIN", "FOG", "ICE", "VISIBILITY"]
AIRCRAFT_WORDS = ["CRASH", "PLANE", "AIRCRAFT"]
STOP_WORDS = ["ZERO", "ONE", "TWO", "THREE", "FOUR", "FIVE"]

# Sighting shapes that look like aircraft within a duration range (seconds).
AIRCRAFT_SHAPES = [(["DISK", "CIRCLE", "SPHERE"], 30, 300), (["LIGHT", "FIREBALL"], 10, 120)]

COUNTRY_SYNONYMS = {
    "UNITED STATES": ["US", "USA", "UNITED STATES"],
    "UNITED KINGDOM": ["UK", "UNITED KINGDOM", "ENGLAND", "SCOTLAND", "WALES"],
    "CANADA": ["CA", "CANADA"],
    "AUSTRALIA": ["AU", "AUSTRALIA"],
    "GERMANY": ["DE", "GERMANY"],
    "FRANCE": ["FR", "FRANCE"],
}
STATE_REGIONS = {
    "US West": ["CA", "OR", "WA", "NV", "AK", "HI"],
    "US Southwest": ["TX", "NM", "AZ", "OK", "AR", "LA"],
    "US Southeast": ["FL", "GA", "SC", "NC", "VA", "WV", "KY", "TN", "AL", "MS"],
    "US Northeast": ["NY", "NJ", "PA", "CT", "RI", "MA", "VT", "NH", "ME", "MD", "DE", "DC"],
    "US Midwest": ["IL", "IN", "OH", "MI", "WI", "MN", "IA", "MO", "ND", "SD", "NE", "KS"],
    "US Mountain": ["MT", "WY", "CO", "UT", "ID"],
}
STATE_REGION_ELSE = "US Other"
COUNTRY_REGIONS = {
    "Canada": ["CANADA"],
    "United Kingdom": ["UNITED KINGDOM"],
    "Western Europe": [
        "GERMANY", "FRANCE", "ITALY", "SPAIN", "NETHERLANDS", "BELGIUM", "SWITZERLAND", "AUSTRIA",
    ],
    "Australia": ["AUSTRALIA"],
}
COUNTRY_REGION_ELSE = "Other International"
# A sighting country also matches crash countries whose raw text contains the word.
CRASH_COUNTRY_WORDS = {"UNITED STATES": "USA", "CANADA": "CANADA"}
STATE_COUNTRY = "United States of America"
STATE_COUNTRY_CODE = "USA"

# Measure limits (inclusive).
TEMPERATURE_LIMITS = (-100, 60)
WIND_LIMITS = (0, 500)
BEARING_LIMITS = (0, 360)
VISIBILITY_LIMITS = (0, 100)
COVER_LIMITS = (0, 100)
PRESSURE_LIMITS = (800, 1200)

# Additive hazard scores and the category values that raise them.
ADVERSE_WEATHER = ["STORMY", "RAINY", "SNOWY"]
POOR_VISIBILITY = ["POOR", "VERY_POOR"]
HIGH_WIND = ["STRONG", "VERY_STRONG"]
HEAVY_COVER_ABOVE = 80
HAZARD_POINTS = {
    "adverse_weather": 2,
    "poor_visibility": 3,
    "high_winds": 2,
    "heavy_cloud_cover": 1,
    "precipitation_present": 1,
}

PROXIMITY_DAYS = 365
PROXIMITY_FIRST_YEAR = 1947
WEATHER_FIRST_YEAR = 1950
# (closest same-country distance in days, correlation score).
CORRELATION_SCORES = [(1, 5), (7, 4), (30, 3), (90, 2)]
CORRELATION_LABELS = [(1, "VERY_HIGH"), (7, "HIGH"), (30, "MODERATE"), (90, "LOW")]
CORRELATION_LOWEST = "VERY_LOW"

MONTH_SHAPES = {
    "light_sightings": "LIGHT",
    "triangle_sightings": "TRIANGLE",
    "circle_sightings": "CIRCLE",
    "disk_sightings": "DISK",
    "sphere_sightings": "SPHERE",
    "other_shape_sightings": "OTHER",
}
MONTH_DURATIONS = ["very_short_duration", "short_duration", "medium_duration", "long_duration"]
MONTH_DURATION_ABOVE = "very_long_duration"

# Sentences of the false-positive reports.
CASE_STRONG = (
    "UFO sighting occurred within ",
    " days of aircraft crash. Sighting characteristics match aircraft debris/explosion.",
)
CASE_WEEK = ("UFO sighting occurred within ", " days of aircraft crash in nearby area.")
CASE_MONTH = (
    "UFO sighting shows aircraft-like characteristics and occurred within ",
    " days of aviation incident.",
)
CASE_ELSE = "Temporal/spatial correlation with aviation incident detected."
ASSESS_STRONG = (
    "High probability false positive - aircraft incident within week with matching characteristics"
)
ASSESS_WEEK = "Moderate probability false positive - aircraft incident within week"
ASSESS_MONTH = (
    "Low probability false positive - aircraft incident within month with matching characteristics"
)
ASSESS_ELSE = "Minimal correlation with aircraft incidents"

# (category, subject, narrative) of the summary rows.
SUMMARY_TOTAL = ("overall_statistics", "total_ufo_sightings", "Total UFO sightings in database")
SUMMARY_EXPLAINED = (
    "overall_statistics",
    "potentially_explained_sightings",
    "UFO sightings with potential aircraft correlation",
)
SUMMARY_HIGH = (
    "overall_statistics",
    "high_confidence_debunking",
    "High-confidence debunking cases with strong evidence",
)
SUMMARY_CRASHES = (
    "aviation_safety", "total_crashes_analyzed", "Total aircraft crashes with weather data",
)
SUMMARY_ATTRIBUTED = (
    "aviation_safety",
    "weather_attributed_crashes",
    "Crashes explicitly attributed to weather conditions",
)
# (area, metric name, description) of the short summary.
KPI_SIGHTINGS = ("UFO_ANALYSIS", "Total UFO Sightings", "All UFO sightings in database")
KPI_COUNTRIES = (
    "UFO_ANALYSIS", "Countries with Sightings", "Number of countries with UFO reports",
)
KPI_ACTIVE = (
    "UFO_ANALYSIS", "High Activity Locations", "Cities with high UFO activity levels",
)
KPI_SUSPICIOUS = (
    "AIRCRAFT_CORRELATION",
    "Suspicious UFO Cases",
    "UFO sightings with potential aircraft correlation",
)
KPI_HIGH = (
    "AIRCRAFT_CORRELATION",
    "High Suspicion Cases",
    "UFO cases with high probability of being aircraft incidents",
)
KPI_FEATURES = (
    "AIRCRAFT_CORRELATION",
    "Aircraft-like Features",
    "UFO reports showing aircraft-like characteristics",
)
KPI_RISKS = (
    "WEATHER_AVIATION",
    "Weather Risk Categories",
    "Different weather severity levels analyzed",
)
KPI_AREAS = (
    "WEATHER_AVIATION",
    "Geographic Risk Areas",
    "Countries/regions with aviation weather risk data",
)
KPI_TYPES = (
    "WEATHER_AVIATION",
    "Aircraft Vulnerability Types",
    "Aircraft types with weather vulnerability analysis",
)

# Labels of sightings and regions, from the strongest to the weakest.
SUSPICION_LABELS = ["HIGH_SUSPICION", "MODERATE_SUSPICION", "LOW_SUSPICION", "MINIMAL_SUSPICION"]
EVIDENCE_LABELS = ["STRONG_EVIDENCE", "MODERATE_EVIDENCE", "WEAK_EVIDENCE", "NO_EVIDENCE"]
REGION_ACTIVITY_LABELS = ["HIGH_ACTIVITY_REGION", "MODERATE_ACTIVITY_REGION", "LOW_ACTIVITY_REGION"]
CITY_ACTIVITY_LABELS = [
    "VERY HIGH ACTIVITY", "HIGH ACTIVITY", "MEDIUM ACTIVITY", "LOW ACTIVITY", "MINIMAL ACTIVITY",
]
