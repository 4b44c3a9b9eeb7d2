"""Fixed values. They must equal published conventions for right results, so they stand here as plain text."""

# --- numbers -------------------------------------------------------------------------------------------------
MISSING = 1.0e20  # stored in place of a missing value
EARTH_RADIUS_M = 6371000.0
REFERENCE_PRESSURE_PA = 100000.0
MONOTONE_STEP = 1.0e-12  # smallest step between two axis points
VALID_WEIGHT_TOLERANCE = 1.0e-6  # below this a regridded cell is missing
HPA_LIMIT = 2000.0  # unit-less pressures up to here are hPa
PERCENT_LIMIT = 1.0 + 1.0e-6  # fractions up to here are 0..1, not percent
SIGMA_LEVELS = ("standard_hybrid_sigma", "alevel", "alev")

# --- regridding ----------------------------------------------------------------------------------------------
# Variables interpolated bilinearly unless told otherwise.
INTENSIVE_VARIABLES = (
    "tas", "tasmin", "tasmax", "psl", "ps", "huss", "uas", "vas", "sfcWind", "ts", "prsn", "clt", "ta", "ua",
    "va", "zg", "hus",
)
LAND_FRACTION_NAMES = ("LANDFRAC", "landfrac", "landmask", "frac_lnd")
SEA_FRACTION_NAMES = ("sftof", "ocnfrac", "wet")


# --- native inputs -----------------------------------------------------------------------------------------------
PRESSURE_INPUTS = ("PS", "hyam", "hybm", "P0")
HYBRID_INPUTS = ("PS", "hyam", "hybm", "hyai", "hybi", "P0", "ilev")
STATIC_INPUTS = ("area", "landmask", "landfrac", "TLAT")
STATIC_CARRIED = ("landfrac", "area", "landmask", "wet", "TLAT")
ICE_GRID_CARRIED = ("TLAT", "TLON", "latt_bounds", "lont_bounds")
OCEAN_STATIC = ("deptho", "areacello")
DIMENSION_NAMES = {
    "levgrnd": "sdepth",
    "levsoi": "sdepth",
    "zl": "olevel",
    "zi": "olevel",
    "xh": "longitude",
    "xq": "longitude",
    "yh": "latitude",
    "yq": "latitude",
}

# --- realms ------------------------------------------------------------------------------------------------------
CANONICAL_REALM = {"aerosol": "atmos", "atmosChem": "atmos", "ocnBgchem": "ocean"}
HYBRID_REALMS = ("atmos", "atmosChem", "aerosol")
SKIPPED_REGION = "30S-90S"

# --- history file patterns: model -> realm -> frequency -> file-name parts --------------------------------------
HISTORY_PATTERNS = {
    "cesm": {
        "aerosol": {"mon": ["cam.h0a"], "day": ["cam.h1a"], "6hr": ["cam.h2a"], "3hr": ["cam.h3a"]},
        "atmosChem": {"mon": ["cam.h0a"], "day": ["cam.h1a"], "6hr": ["cam.h2a"], "3hr": ["cam.h3a"]},
        "atmos": {"mon": ["cam.h0a"], "day": ["cam.h1a"], "6hr": ["cam.h2a"], "3hr": ["cam.h3a"]},
        "land": {"mon": ["clm2.h0a"]},
        "ocnBgchem": {"mon": ["mom6.h.z", "mom6.h.native."], "day": ["mom6.h.sfc"]},
        "ocean": {"mon": ["mom6.h.z", "mom6.h.native."], "day": ["mom6.h.sfc"]},
        "seaIce": {"mon": ["cice.h."], "day": ["cice.h1."]},
    },
    "noresm": {
        "atmos": {"mon": ["cam.h0a"], "day": ["cam.h1a"], "6hr": ["cam.h2a"], "3hr": ["cam.h4a"]},
        "atmosChem": {"mon": ["cam.h0a"], "day": ["cam.h1a"], "6hr": ["cam.h2a"], "3hr": ["cam.h4a"]},
        "aerosol": {"mon": ["cam.h0a"], "day": ["cam.h1a"], "6hr": ["cam.h2a"], "3hr": ["cam.h4a"]},
        "land": {"mon": ["clm2.h0a"], "day": ["clm2.h1a"], "3hr": ["clm2.h2a"], "yr": ["clm2.h2a"]},
        "seaIce": {"mon": ["cice.h."], "day": ["cice.h1."]},
    },
}

#: Columns of slices that are their time axis, not variables.
TIME_COLUMNS = ("time", "time_b0", "time_b1")

# --- output tree -------------------------------------------------------------------------------------------------
TREE_FACETS = (
    "mip_era", "activity_id", "institution_id", "source_id", "experiment_id", "variant_label", "region",
    "frequency", "variable_id", "branding_suffix", "grid_label",
)

# --- texts searched in logs and file names -------------------------------------------------------------------------
LOG_NAME_PATTERN = r"^cmor_\d{8}T\d{6}Z_(.+)\.log$"
LOG_ERROR_PATTERN = r"(?i)Error: "
LOG_SUCCESS_PATTERN = r"(?i)\b(success|complete(?:d)?|finished)\b"
NO_MAPPING_PATTERN = r"No mapping for (.+) in "
NO_INPUT_PATTERN = r"Variable (.*) processed with status: ERROR \w+ input variable not found\."
NO_INPUT_PATTERN_NEW = r"Source variable\(s\) not found for ([^,\s]+)"
FILE_MONTH_PATTERN = r"[.\-](\d{4})(-?)(0[1-9]|1[0-2])\.nc(?!\S)"

# --- catalog sheets ------------------------------------------------------------------------------------------------
SHEET_DIMENSION_NAMES = {"longitude": "lon", "latitude": "lat", "alevel": "lev", "time4": "time"}
SOURCE_SKIP_PHRASES = ("?", "n/a", "derived", "IN SURF DATASET", "can be derived")
NAME_SKIP_PHRASES = ("_tpt-", "_tclm-", "_tclmdc-", "_tminavg-")
EXPRESSION_WORDS = (
    "np", "xr", "math", "sqrt", "abs", "sum", "min", "max", "mean", "verticalsum", "where", "zeros", "ones",
    "True", "False", "None", "dim", "capped_at", "skipna",
)
# Name ending -> dimension summed over, for names that start with FATES.
FATES_SUM_DIMENSIONS = {
    "PF": "fates_levpft",
    "LU": "fates_levlanduse",
    "DC": "fates_levcwdsc",
    "EL": "fates_levelem",
    "SZ": "fates_levscls",
}
DIMENSION_ORDER = ("time", "plev", "lat", "lon")
SKIPPED_TABLES = ("CV", "coordinate", "formula_terms", "grids", "cell_measures", "long_name_overrides")
COORDINATE_FILES = ("CMIP7_coordinate.json", "CMIP6_coordinate.json", "CMIP_coordinate.json")

# --- sign convention by variable name ------------------------------------------------------------------------------
POSITIVE_DIRECTION = {
    "hfls_tavg-u-hxy-u": "up",
    "hfss_tavg-u-hxy-u": "up",
    "rlds_tavg-u-hxy-u": "up",
    "rls_tavg-u-hxy-u": "up",
    "rlut_tavg-u-hxy-u": "up",
    "rlutcs_tavg-u-hxy-u": "up",
    "rlutaf_tavg-u-hxy-u": "up",
    "rlutcsaf_tavg-u-hxy-u": "up",
    "rsds_tavg-u-hxy-u": "up",
    "rsdscs_tavg-u-hxy-u": "up",
    "rsdt_tavg-u-hxy-u": "up",
    "rss_tavg-u-hxy-u": "down",
    "rsuscs_tavg-u-hxy-u": "up",
    "rsutcs_tavg-u-hxy-u": "up",
    "rsut_tavg-u-hxy-u": "up",
    "rsutaf_tavg-u-hxy-u": "up",
    "rsutcsaf_tavg-u-hxy-u": "up",
    "rlus_tavg-u-hxy-u": "up",
    "rluscsaf_tavg-u-hxy-u": "up",
    "rsus_tavg-u-hxy-u": "up",
    "rtmt_tavg-u-hxy-u": "down",
    "tauu_tavg-u-hxy-u": "down",
    "tauv_tavg-u-hxy-u": "down",
    "fFire_tavg-u-hxy-lnd": "up",
    "npp_tavg-u-hxy-lnd": "up",
    "rh_tavg-u-hxy-lnd": "up",
    "rsds_tavg-u-hxy-lnd": "down",
    "rsds_tavg-u-hxy-sn": "down",
    "rsus_tavg-u-hxy-lnd": "up",
    "rsus_tavg-u-hxy-sn": "up",
    "tran_tavg-u-hxy-lnd": "up",
    "evspsblsoi_tavg-u-hxy-u": "up",
    "evspsblveg_tavg-u-hxy-u": "up",
    "ra_tavg-u-hxy-lnd": "up",
    "fN2O_tavg-u-hxy-lnd": "up",
    "nbp_tavg-u-hxy-lnd": "down",
}
