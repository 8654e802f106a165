"""Fixed values that must equal the reference's for the same results.

Fixed values, in the reference's order of use:
"""

# Data split and problem type
LOW_CARD_THRESHOLD = 15          # numeric with more distinct values -> regression; <= 15 -> low cardinality

# profiling
TOP_VALUES = 15
TOP_TARGET_CORR = 8
TOP_OUTLIER_COLUMNS = 20

# Modelling and evaluation
MAPE_NONZERO = 1e-6
MINUTES_PER_DAY = 1440

# Scoring form and batch upload
PEAK_MONTHS = (5, 6, 7, 12)
WEEKEND_DAYS_FORM = ("Friday", "Saturday")
LABEL_SEPARATOR = " — "
ENCODINGS = ("utf-8", "latin-1", "cp1252")
SEPARATORS = (",", ";", "\t", "|")
