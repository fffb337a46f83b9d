"""Explicit schemas, as DDL strings.

Inference is avoided by default: it turns the code '01002' into the number 1002.
"""

from cutline.fixed_values import RAW_COLUMNS

# CSV fields are read as text and coerced afterwards, because counters with gaps arrive as '1.0'.
RAW_TEXT_SCHEMA = ", ".join(f"{name} string" for name, _ in RAW_COLUMNS)
MALFORMED = "_malformed"  # text of a row that has more or fewer fields than its header
INTEGER_COLUMNS = tuple(name for name, kind in RAW_COLUMNS if kind == "int")
BOOLEAN_COLUMNS = tuple(name for name, kind in RAW_COLUMNS if kind == "boolean")

METRICS_SCHEMA = (
    "run_id string, run_ts timestamp, layer string, rule_name string, rows_checked bigint, "
    "rows_failed bigint, pct_failed double, status string, notes string"
)
CONVERSION_LOG_SCHEMA = (
    "status string, file string, round string, rows int, warnings int, method string, "
    "elapsed_s double, ts string, error string"
)
LEDGER_SCHEMA = "run_id string, ts timestamp, layer string, operation string, rows bigint, folder string"
