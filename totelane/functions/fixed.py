"""Fixed values of the warehouse and its conveyor. Results depend on them; do not edit."""

# Pick areas whose goods do not fit the conveyor (first two characters).
NONCON_AREAS = ("WW", "XX", "YY", "ZZ")

# First-floor location codes kept as they are (first three characters).
KEPT_FLOOR = ("1UA", "1XG")

# Numbered aisles whose goods do not fit the conveyor (first two characters).
NONCON_AISLES = ("00", "99")

# First and last three-character code and the zone they belong to.
FLOOR_ZONES = (
    ("1UA", "1VA", "FB"),
    ("1VB", "1VF", "FD"),
    ("1VG", "1WB", "HB"),
    ("1WC", "1WG", "HD"),
    ("1WH", "1XB", "JB"),
    ("1XC", "1XG", "JD"),
)

# Zones a RANDOM location is spread over.
SPREAD_ZONES = (
    "AD", "AF", "AH", "BA", "BB", "BC", "BD", "CB", "CD",
    "CF", "CH", "DA", "DB", "DC", "DD", "EF", "EH", "FA",
    "FC", "GF", "GH", "HA", "HC", "IF", "IH", "JA", "JC",
)

# Zone per leading digit 0 to 9 in the legacy spread, where a draw is
# compared as text and only six zones can be reached.
LEGACY_SPREAD = ("AD", "AD", "AD", "CB", "AF", "AF", "AF", "FA", "GH", "IF")

# Special locations (as keys), special zones and the route without stops.
PACKING_LOCATION = "PACKING"
RANDOM_LOCATION = "RANDOM"
HOSPITAL_LOCATION = "HOSPITAL"
NONCON_ZONE = "NC"
HOSPITAL_ZONE = "Hospital"
PACKING_ZONE = "Packing"
NO_STOPS = "-"
DELIMITER = "-"

# Chutes, and the flag of a tote with goods that do not fit the conveyor.
CHUTE_DONE = 1
CHUTE_RECIRCULATE = 3
CHUTE_NONCON = 4
NONCON_FLAG = 4

# Transaction types and order status, as keys.
PICK = "PICK"
REPLENISH = "REPL"
PUT_AWAY = "PUTAWAY"
PICKED_STATUS = "PICKED"

# Hours after which a sent route is dropped; answer of an accepted message.
ROUTE_TTL_HOURS = 1
ACCEPTED = 201
