"""Fixed values of the domain.

Everything in this file is a value that must be exactly this one for results to
be right: column names, sentinels, patterns, bin limits, codes and bands.
"""

# --- keys and stamps -------------------------------------------------------
CUSTOMER = "Customer_ID"
SNAPSHOT = "snapshot_date"
UNKNOWN = "Unknown"
META_COLUMNS = ["Customer_ID", "loan_id", "snapshot_date", "label_date", "label", "label_def"]

# --- clickstream panel -----------------------------------------------------
EMA_ALPHA = 0.1
PANEL_COLUMNS = [f"fe_{i}" for i in range(1, 21)]

# --- cleansing -------------------------------------------------------------
SSN_PATTERN = r"^\d{3}-\d{2}-\d{4}$"
SYMBOLS_ONLY_PATTERN = r"^[^a-zA-Z]+$"
YEARS_PATTERN = r"(\d+)\s+[Yy]ear"
MONTHS_PATTERN = r"(\d+)\s+[Mm]onth"
SPENT_PATTERN = r"^(.+)_spent_"
VALUE_PATTERN = r"_spent_(.+)_value_payments$"

INVESTED_SENTINEL = "__10000__"
BALANCE_SENTINEL = "__-333333333333333333333333333__"
BEHAVIOUR_SENTINEL = "!@9#%8"
CREDIT_MIX_SENTINEL = "_"

AGE_RANGE = (18, 56)
DELAY_DAYS_RANGE = (0, 62)
DELAYED_PAYMENTS_RANGE = (0, 28)
MAX_BANK_ACCOUNTS = 11
MAX_CREDIT_CARDS = 11
MAX_INTEREST_RATE = 34
MAX_INQUIRIES = 17
MAX_EMI = 863

# --- labels ----------------------------------------------------------------
DEFAULT_DPD = 30
DEFAULT_MOB = 6

# --- features --------------------------------------------------------------
MEDIAN_COLUMNS = [
    "Age", "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate",
    "Delay_from_due_date", "Num_of_Delayed_Payment", "Changed_Credit_Limit",
    "Num_Credit_Inquiries", "Total_EMI_per_month", "Amount_Invested_Monthly",
]
# upper limits (exclusive) and the labels of the bins they close; the last label
# is the open top bin
BINS = {
    "Monthly_Inhand_Salary": ([1500, 2600, 4000, 6700],
                              ["<1500", "1500-2600", "2600-4000", "4000-6700", ">6700"]),
    "Outstanding_Debt": ([1500, 2500], ["<1500", "1500-2500", ">2500"]),
    "Total_EMI_per_month": ([25, 50, 100, 200],
                            ["<25", "25-50", "50-100", "100-200", ">200"]),
    "Amount_Invested_Monthly": ([65, 110, 170, 320],
                                ["<65", "65-110", "110-170", "170-320", ">320"]),
}
CREDIT_MIX_CODES = {"Bad": 0, "Unknown": 1, "Standard": 2, "Good": 3}
SPENT_LEVEL_CODES = {"Low": 0, "High": 1}
VALUE_PAYMENTS_CODES = {"Small": 0, "Medium": 1, "Large": 2}

# --- training and monitoring -----------------------------------------------
SPLIT_SEED = 42
SPLIT_PERCENT = {"train": 80, "val": 10, "test": 10}
OOT_MONTHS = 2
THRESHOLD_GRID = [round(0.05 * i, 2) for i in range(1, 20)]
MIN_PRECISION = 0.5
FALLBACK_THRESHOLD = 0.5
TOP_FEATURES = 10
DRIFT_BINS = 10
SHARE_FLOOR = 1e-6
MATURITY_MONTHS = 6
# metric -> (green limit, yellow limit, higher is better)
BANDS = {
    "gini": (0.65, 0.60, True),
    "recall": (0.65, 0.60, True),
    "psi": (0.10, 0.25, False),
    "csi": (0.10, 0.25, False),
}
