"""Names, codes, limits and lists that decide results."""

# Station quality bounds (degrees, inclusive).
LONDON_BOX = {"lat": (51.28, 51.69), "lon": (-0.51, 0.33)}

# Plausible seconds to a stop, inclusive.
ARRIVAL_SECONDS = (-60, 3600)

# Metres and kilometres per degree used for the box around a point.
KM_PER_DEGREE = 111.0
M_PER_DEGREE = 111_000.0

# Sentinels for validity and high-water marks.
EPOCH = "1970-01-01 00:00:00"
FAR_FUTURE = "9999-12-31 00:00:00"

# Quality rules as (check, minimum, maximum).
QUALITY_RULES = [
    ("freshness", 1, None),
    ("nulls", None, 0),
    ("completeness", 100, None),
]

# The freshness limit per layer, in seconds.
LAYER_LAG_SECONDS = {"raw": 120, "curated": 180, "analytics": 3600}

# Monitoring thresholds.
FALLBACK_LIMIT = 0.20
RATE_FLOOR = 0.001

# Line dimension as (id, name, colour, ink, order).
LINES = [
    ("bakerloo", "Bakerloo", "#B36305", "#FFFFFF", 1),
    ("central", "Central", "#E32017", "#FFFFFF", 2),
    ("circle", "Circle", "#FFD300", "#111111", 3),
    ("district", "District", "#00782A", "#FFFFFF", 4),
    ("hammersmith-city", "Hammersmith & City", "#F3A9BB", "#111111", 5),
    ("jubilee", "Jubilee", "#A0A5A9", "#111111", 6),
    ("metropolitan", "Metropolitan", "#9B0056", "#FFFFFF", 7),
    ("northern", "Northern", "#000000", "#FFFFFF", 8),
    ("piccadilly", "Piccadilly", "#003688", "#FFFFFF", 9),
    ("victoria", "Victoria", "#0098D4", "#FFFFFF", 10),
    ("waterloo-city", "Waterloo & City", "#95CDBA", "#111111", 11),
    ("elizabeth", "Elizabeth", "#6950A1", "#FFFFFF", 12),
    ("dlr", "DLR", "#00A4A7", "#FFFFFF", 13),
    ("london-overground", "London Overground", "#EE7C0E", "#FFFFFF", 14),
    ("tram", "Tram", "#84B817", "#111111", 15),
]

# Presentation of a line that is not in the dimension.
UNKNOWN_LINE = {"colour": "#555555", "ink": "#FFFFFF", "order": 99}

# Lines of the synthetic feed as (id, name, mode).
FEED_LINES = [
    ("bakerloo", "Bakerloo", "tube"),
    ("central", "Central", "tube"),
    ("circle", "Circle", "tube"),
    ("district", "District", "tube"),
    ("hammersmith-city", "Hammersmith & City", "tube"),
    ("jubilee", "Jubilee", "tube"),
    ("metropolitan", "Metropolitan", "tube"),
    ("northern", "Northern", "tube"),
    ("piccadilly", "Piccadilly", "tube"),
    ("victoria", "Victoria", "tube"),
    ("waterloo-city", "Waterloo & City", "tube"),
    ("elizabeth", "Elizabeth line", "elizabeth-line"),
    ("dlr", "DLR", "dlr"),
    ("london-overground", "London Overground", "overground"),
]

# Severity codes, and how many of 12 draws each one gets.
SEVERITIES = [
    (0, "Special Service", 1),
    (1, "Closed", 1),
    (2, "Suspended", 1),
    (5, "Part Closure", 1),
    (6, "Severe Delays", 1),
    (7, "Reduced Service", 1),
    (9, "Minor Delays", 1),
    (10, "Good Service", 5),
]

# Streams as (domain, label, topic, description).
TOPICS = [
    ("tfl", "London Transport", "tfl.analytics.line-status-latest", "Live tube line status (compacted)"),
    ("tfl", "London Transport", "tfl.curated.bike-occupancy", "Enriched bike station availability (compacted)"),
    ("tfl", "London Transport", "tfl.raw.line-status", "Raw line status events"),
    ("tfl", "London Transport", "tfl.raw.bus-arrivals", "Raw bus arrival predictions"),
    ("tfl", "London Transport", "tfl.raw.bike-points", "Raw bike point snapshots"),
]

# Operations of the access rules, by kind of object.
CATALOG_READ = ["LIST_CATALOGS", "GET_CATALOG"]
CATALOG_WRITE = ["CREATE_CATALOG", "UPDATE_CATALOG", "DELETE_CATALOG"]
NAMESPACE_READ = ["LIST_NAMESPACES", "LOAD_NAMESPACE_METADATA", "NAMESPACE_EXISTS"]
NAMESPACE_WRITE = ["CREATE_NAMESPACE", "UPDATE_NAMESPACE_PROPERTIES", "DROP_NAMESPACE"]
TABLE_READ = ["LIST_TABLES", "LOAD_TABLE", "LOAD_TABLE_WITH_READ_DELEGATION", "TABLE_EXISTS"]
TABLE_WRITE = [
    "CREATE_TABLE_DIRECT",
    "CREATE_TABLE_DIRECT_WITH_WRITE_DELEGATION",
    "CREATE_TABLE_STAGED",
    "CREATE_TABLE_STAGED_WITH_WRITE_DELEGATION",
    "REGISTER_TABLE",
    "LOAD_TABLE_WITH_WRITE_DELEGATION",
    "UPDATE_TABLE",
    "UPDATE_TABLE_FOR_STAGED_CREATE",
    "DROP_TABLE_WITHOUT_PURGE",
    "DROP_TABLE_WITH_PURGE",
    "RENAME_TABLE",
    "COMMIT_TRANSACTION",
    "REPORT_METRICS",
    "SEND_NOTIFICATIONS",
]
TABLE_METADATA_WRITE = [
    "ASSIGN_TABLE_UUID",
    "UPGRADE_TABLE_FORMAT_VERSION",
    "ADD_TABLE_SCHEMA",
    "SET_TABLE_CURRENT_SCHEMA",
    "ADD_TABLE_PARTITION_SPEC",
    "ADD_TABLE_SORT_ORDER",
    "SET_TABLE_DEFAULT_SORT_ORDER",
    "ADD_TABLE_SNAPSHOT",
    "SET_TABLE_SNAPSHOT_REF",
    "REMOVE_TABLE_SNAPSHOTS",
    "REMOVE_TABLE_SNAPSHOT_REF",
    "SET_TABLE_LOCATION",
    "SET_TABLE_PROPERTIES",
    "REMOVE_TABLE_PROPERTIES",
    "SET_TABLE_STATISTICS",
    "REMOVE_TABLE_STATISTICS",
    "REMOVE_TABLE_PARTITION_SPECS",
]
VIEW_READ = ["LIST_VIEWS", "LOAD_VIEW", "VIEW_EXISTS"]
VIEW_WRITE = ["CREATE_VIEW", "REPLACE_VIEW", "DROP_VIEW", "RENAME_VIEW"]

# Catalogs that non-admin roles may touch.
WAREHOUSES = ["raw", "curated", "analytics"]
