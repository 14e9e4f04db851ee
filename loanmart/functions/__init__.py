"""Column expressions (built-in Spark functions only, no Python UDF)."""

from loanmart.functions.text import (  # noqa: F401
    blank_to_null, case_hash, clean_symbols, full_name, has_label, null_token_to_null,
    py_strip, recode, status_is, strip_quotes,
)
from loanmart.functions.numbers import (  # noqa: F401
    to_decimal_exact, to_decimal_rounded, to_double_strict, to_number,
)
from loanmart.functions.dates import (  # noqa: F401
    days_until, parse_date, parse_timestamp, pacific_stamp, reformat_date,
    try_parse_timestamp, utc_to_pacific,
)
