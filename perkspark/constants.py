"""Fixed values of the loyalty domain.

These values must equal the source programme's for the results to match, so
they are stated plainly here, in one place.
"""

# --- fixed values: event names (data dictionary of the programme) ---------
EVENT_RECEIVED = "offer received"
EVENT_VIEWED = "offer viewed"
EVENT_COMPLETED = "offer completed"
EVENT_TRANSACTION = "transaction"
OFFER_EVENTS = (EVENT_RECEIVED, EVENT_VIEWED, EVENT_COMPLETED)

# --- fixed values: marketing channels, in the order the programme lists them
#: Column of a channel matrix for offers whose channel text is empty.
UNNAMED_CHANNEL = "unnamed"

# --- fixed values: offer types ----------------------------------------------
OFFER_TYPES = ("bogo", "discount", "informational")

# --- fixed values: age buckets (upper bound exclusive, label) ---------------
# Ages below 18 get their own bucket and ages at or above 65 fall in "65+".
AGE_UNDER_MIN_LABEL = "<18"
AGE_MIN = 18
AGE_BUCKETS = ((25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64"))
AGE_TOP_LABEL = "65+"
AGE_MAX_VALID = 101

# --- fixed values: income brackets (upper bound exclusive, label) -----------
INCOME_BUCKETS = ((40000, "Low"), (80000, "Medium"), (120000, "High"))
INCOME_TOP_LABEL = "Very High"

# --- fixed values: data quality flags -----------------------------------------
FLAG_INCOMPLETE = "incomplete"
FLAG_INVALID_AGE = "invalid_age"
FLAG_INVALID_INCOME = "invalid_income"
FLAG_VALID = "valid"

# --- fixed values: completion status ----------------------------------------
STATUS_COMPLETED = "Completed"
STATUS_NOT_COMPLETED = "Not Completed"

# --- fixed values: channel performance levels (rate >= threshold) -----------
PERFORMANCE_LEVELS = ((50, "High"), (30, "Medium"))
PERFORMANCE_FLOOR = "Low"

# --- fixed values: layer namespaces ----------------------------------------------
LAYER_RAW = "bronze"
LAYER_CLEANSED = "silver"
LAYER_METRICS = "gold"

# Default start of the 30-day observation period (event clock = hours since).
DEFAULT_PERIOD_START = "2018-01-01 00:00:00"
# Default reference date for membership durations; a parameter so runs repeat.
DEFAULT_AS_OF = "2018-08-01"
