"""Fixed values of the study: cities, epochs, sensors, thresholds, palettes."""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------

CITIES = ["riverside", "phoenix", "las_vegas", "austin"]
YEARS = [1990, 2000, 2010, 2020]
PERIODS = [(1990, 2000), (2000, 2010), (2010, 2020)]

CITY_LABELS = {
    "riverside": "Riverside",
    "phoenix": "Phoenix",
    "las_vegas": "Las Vegas",
    "austin": "Austin",
}
CITY_COLORS = {
    "riverside": "#2F6F4E",
    "phoenix": "#E76F51",
    "las_vegas": "#4C9BE8",
    "austin": "#7A9E7E",
}

# city -> (lon_min, lat_min, lon_max, lat_max)
REGIONS = {
    "riverside": (-117.55, 33.85, -117.20, 34.10),
    "phoenix": (-112.30, 33.25, -111.90, 33.65),
    "las_vegas": (-115.35, 35.95, -114.95, 36.35),
    "austin": (-97.95, 30.10, -97.55, 30.50),
}

# epoch -> sensor collection
SENSORS = {1990: "LT05", 2000: "LT05", 2010: "LE07", 2020: "LC08"}

RAW_BANDS = ["sr_b1", "sr_b2", "sr_b3", "sr_b4", "sr_b5"]
# file formats: columns of the sample files, those that charts need, and the metrics file
SAMPLE_SCHEMA = "red double, green double, blue double, nir double, ndvi double, label int, city string, year int, subclass string"
SAMPLE_COLUMNS = ["red", "green", "blue", "nir", "ndvi", "label", "city", "year", "subclass"]
DASHBOARD_COLUMNS = ["year", "subclass", "red", "green", "blue", "nir", "ndvi"]
METRICS_SCHEMA = (
    "city string, year int, urban_area_km2 double, growth_km2 double, growth_pct double, growth_pct_display string"
)

BANDS = ["red", "green", "blue", "nir"]
FEATURES = ["red", "green", "blue", "nir", "ndvi"]

# sensor -> raw band behind each named band
BAND_MAP = {
    "LT05": {"red": "sr_b3", "green": "sr_b2", "blue": "sr_b1", "nir": "sr_b4"},
    "LE07": {"red": "sr_b3", "green": "sr_b2", "blue": "sr_b1", "nir": "sr_b4"},
    "LC08": {"red": "sr_b4", "green": "sr_b3", "blue": "sr_b2", "nir": "sr_b5"},
}

SCALE = 2.75e-05
OFFSET = -0.2
CLOUD_BIT = 1 << 3
SHADOW_BIT = 1 << 4

# city -> epoch -> smallest probability that counts as urban
THRESHOLDS = {
    "riverside": {1990: 0.80, 2000: 0.80, 2010: 0.80, 2020: 0.63},
    "phoenix": {1990: 0.80, 2000: 0.80, 2010: 0.80, 2020: 0.68},
    "las_vegas": {1990: 0.99, 2000: 0.97, 2010: 0.95, 2020: 0.85},
    "austin": {1990: 0.35, 2000: 0.35, 2010: 0.35, 2020: 0.45},
}

NODATA = 255
PIXEL_KM2 = "0.0009"  # 30 m x 30 m, kept as text so that it becomes an exact decimal
PIXEL_METRES = 30.0
METRES_PER_DEGREE = 111319.49

# subclass -> (label, points wanted per city and epoch, seed)
CLASS_QUOTAS = {
    "urban": (1, 300, 1),
    "vegetation": (0, 100, 2),
    "farmland": (0, 100, 3),
    "bare_soil": (0, 100, 4),
    "water": (0, 100, 5),
}
SUBCLASS_ORDER = ["urban", "vegetation", "farmland", "bare_soil", "water"]

FOREST = {"numTrees": 80, "maxDepth": 8, "minInstancesPerNode": 10, "seed": 42}

# class -> RGBA
MAP_PALETTE = {"valid": (240, 237, 232, 255), "urban": (201, 92, 74, 255), "nodata": (0, 0, 0, 0)}
OVERLAY_URBAN = (0.0, 1.0, 1.0, 0.10)

# --- keys -------------------------------------------------------------------

RASTER = ["city", "yr"]
PIXEL = ["city", "yr", "px_row", "px_col"]
STEP_DEGREES = PIXEL_METRES / METRES_PER_DEGREE

#: Buckets of raster tables; tables that are joined must have the same number.
RASTER_BUCKETS = 256
