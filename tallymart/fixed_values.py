"""Fixed values of the sales marts.

Everything here must keep its exact value for the published tables and the error texts to
stay right: formats, rule columns, keys and messages.
"""

# Accepted timestamp formats, tried in this order.
TIMESTAMP_FORMATS = (
    "yyyy-M-d H:m:s",
    "M/d/yyyy H:mm",
    "M/d/yyyy H:m:s",
    "yyyy/M/d H:m:s",
)

# Accepted date formats, tried in this order.
DATE_FORMATS = (
    "yyyy-M-d H:m:s",
    "M/d/yyyy",
    "M/d/yyyy H:m:s",
    "M/d/yyyy H:mm",
)

# Fixed value: the format with fractions of a second that callers may add to TIMESTAMP_FORMATS.
FRACTION_FORMAT = "yyyy-M-d H:m:s.SSS"

# Fixed value: the date-only format that callers may add to DATE_FORMATS.
ISO_DATE_FORMAT = "yyyy-M-d"

# Column types after cleaning.
QUANTITY_TYPE = "int"
PRICE_TYPE = "decimal(12,2)"
RATE_TYPE = "double"
EXACT_RATE_TYPE = "decimal(10,6)"

# Columns a sales line cannot do without.
REQUIRED_SALES_COLUMNS = ("QUANTITY", "PRICE")

# Columns and age limit of the quality gate.
GATE_MISSING_COLUMNS = ("COUNTRY", "PRICE", "QUANTITY")
GATE_NUMERIC_COLUMNS = ("QUANTITY", "PRICE", "REVENUE_LOCAL", "REVENUE_USD")
GATE_DATE_COLUMN = "ORDER_TIMESTAMP"
GATE_RATE_COLUMN = "EXCHANGE_RATE_TO_USD"
GATE_MAX_AGE_DAYS = 90

# Errors about column lists.
EMPTY_LIST_MESSAGE = "Column list cannot be empty"
ABSENT_COLUMNS_MESSAGE = "Columns not found in DataFrame: {absent}"

# Message of each gate rule, and the heading of the error.
GATE_MESSAGES = {
    "missing": "Column '{column}' has {violations} missing values",
    "non_positive": "Column '{column}' has {violations} non-positive values",
    "stale": "Column '{column}' has {violations} records outside last {days} days",
    "future": "Column '{column}' has {violations} future timestamp",
    "rate": "Column '{column}' has {violations} invalid exchange rates",
}
GATE_ERROR_HEADING = "Data validation failed:"

# Names, merge keys and partitions of the two published tables.
INCREMENT_COLUMN = "ORDER_DATE"
CATEGORY_TABLE = "category_summary"
CATEGORY_KEYS = ("COUNTRY", "ORDER_DATE", "CATEGORY")
CATEGORY_PARTITIONS = ("COUNTRY",)
CUSTOMER_TABLE = "customer_summary"
CUSTOMER_KEYS = ("COUNTRY", "ORDER_DATE", "CUSTOMER_ID")
CUSTOMER_PARTITIONS = ("ORDER_DATE",)

# Messages of the check on the published tables.
MISSING_OUTPUT_MESSAGE = "Output directories not found!"
NULL_OUTPUT_MESSAGE = "Null values found in {table} output"
