"""They decide results and therefore have to be exactly these."""

# Sources.
PSA = "psa"
BSP_FX = "bsp_fx"
BSP_POLICY = "bsp_policy"
SOURCES = (PSA, BSP_FX, BSP_POLICY)

# Consumer-price cube: series codes as published, and as the gold contract names them.
CPI_INDEX_MARKER = "ALL_ITEMS"
CPI_INDEX_UNIT = "index (2018=100)"
CPI_RATE_UNIT = "percent"
INDICATOR_CODES = {"CPI_ALL_ITEMS": "CPI_ALL", "CPI_YOY_CHANGE": "CPI_YOY"}
PSA_LIVE_SOURCE = "psa_openstat"
PSA_SEED_SOURCE = "psa_fixture"

# Exchange-rate table.
USD_PHP = "USD/PHP"
FX_FIRST_YEAR = 2010
FX_LIVE_SOURCE = "bsp_table12"
FX_SEED_SOURCE = "bsp_fixture"
MISSING_NUMBERS = ["-", "..", "n.a.", "n/a", ""]
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

# Policy-rate table.
POLICY_LIVE_SOURCE = "bsp_monetary_policy"
POLICY_RATE_MIN = 0.5
POLICY_RATE_MAX = 20.0
HIKE, CUT, HOLD = "hike", "cut", "hold"
DIRECTIONS = [HIKE, CUT, HOLD]

# Metadata enumerations.
RUN_STATUSES = ["RUNNING", "SUCCESS", "FAILED", "PARTIAL"]
FILE_STATUSES = ["SUCCESS", "FAILED", "SKIPPED"]

# Serving.
GOLD_DATASETS = ("gold_macro_indicators", "gold_exchange_rates")
RUN_LIST_DEFAULT, RUN_LIST_MAX = 20, 100
QUALITY_HISTORY_ROWS = 20
LOCAL_ZONE = "Asia/Manila"
EM_DASH = "\u2014"
ELLIPSIS = "\u2026"
