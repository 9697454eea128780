"""Fixed values shared by the operators.

Column names, weights and variable codes below have to stay as they are: input
tables and downstream reports use them.
"""

# --- merchant table -------------------------------------------------------
SALES_COLUMNS = ("TOT_SALES2018", "TOT_SALES2019", "TOT_SALES2020", "TOT_SALES2021")
# the 2019 count column is spelled differently from the others in the source table
COUNT_COLUMNS = ("TOT_SALE_CNT2018", "TOT_SALES_CNT2019", "TOT_SALE_CNT2020", "TOT_SALE_CNT2021")
YEARS = (2018, 2019, 2020, 2021)
RESTAURANT_CODE = "5812"

# --- ranking weights ------------------------------------------------------
SALES_TREND_WEIGHTS = (0.4, 0.6)
COUNT_TREND_WEIGHTS = (0.3, 0.7)

# --- scoring --------------------------------------------------------------
SCORING_COLUMNS = (
    "SALES_TREND_1", "SALES_TREND_2", "SALES_TREND_3",
    "SALES_CNT_TREND_1", "SALES_CNT_TREND_2", "SALES_CNT_TREND_3",
)
SCORING_DIRECTIONS = (1, 1, 1, 1, 1, 1)
SUM_WEIGHTS = (0.2, 0.6, 0.8, 0.2, 0.6, 0.8)
REPORT_COLUMNS = ("MERCHANT_ID", "MERCHANT_NAME", "ZIPCODE", "BILLING_STATE", "CITY", "WEIGHTED_SUM")

# --- census variables (public survey codes) -------------------------------
CENSUS_VARIABLES = {"B01001_002E": "population_male", "B01001_026E": "population_female"}
CENSUS_YEARS = (2020, 2019, 2018)

# --- models ---------------------------------------------------------------
IMPORTANCE_ROWS = 5000
IMPORTANCE_SEED = 8464
IMPORTANCE_TREES = 10
IMPORTANCE_SUBSAMPLING = 0.7
IMPORTANCE_TARGET = "TOT_SALES2021"
CLASSIFIER_TREES = 10
TEST_RATIO = 0.2
