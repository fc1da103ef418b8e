"""Vocabularies and constants of the data model."""

# The vocabularies and constants that results depend on.
DRIVABLE = [
    "motorway",
    "motorway_link",
    "trunk",
    "trunk_link",
    "primary",
    "primary_link",
    "secondary",
    "secondary_link",
    "tertiary",
    "tertiary_link",
    "residential",
    "unclassified",
    "living_street",
    "service",
    "track",
    "road",
]
PRIVATE_SERVICE = ["driveway", "parking_aisle"]
CALMING = [
    "bump",
    "mini_bumps",
    "hump",
    "table",
    "cushion",
    "dynamic_bump",
    "dip",
    "double_dip",
    "chicane",
    "choker",
    "island",
]
#: Values of ``traffic_calming`` and their class; other known values are their own class.
CALMING_CLASSES = {
    "bump": "speed_bump",
    "mini_bumps": "speed_bump",
    "hump": "speed_bump",
    "table": "speed_bump",
    "cushion": "speed_bump",
    "dynamic_bump": "speed_bump",
    "dip": "dip",
    "double_dip": "dip",
    "choker": "narrowing",
}
#: Values of ``surface`` and their class.
SURFACE_CLASSES = {
    "asphalt": "asphalt",
    "concrete": "concrete",
    "concrete:plates": "concrete",
    "concrete:lanes": "concrete",
    "paved": "paved",
    "cobblestone": "cobblestone",
    "cobblestone:flattened": "cobblestone",
    "paving_stones": "cobblestone",
    "sett": "cobblestone",
    "gravel": "gravel",
    "fine_gravel": "gravel",
    "pebblestone": "gravel",
    "compacted": "compacted",
    "dirt": "dirt",
    "earth": "dirt",
    "mud": "dirt",
    "sand": "dirt",
    "grass": "grass",
    "grass_paver": "grass",
    "unpaved": "unpaved",
    "ground": "unpaved",
}
UNKNOWN_SURFACE = "unknown"
KEPT_TAGS = ["name", "maxspeed", "surface", "highway", "ref"]
MINI_ROUNDABOUT_RADIUS = 3.0
EARTH_RADIUS_M = 6_371_000.0

#: Tags that are read anywhere; elements hold them as fields of the struct ``tags``.
TAGS = [
    "highway",
    "service",
    "surface",
    "junction",
    "bridge",
    "tunnel",
    "traffic_calming",
    "enforcement",
    "name",
    "maxspeed",
    "ref",
    "area",
]
