"""Column functions (scalar C-series)."""

from innkeeper.functions.columns import (  # noqa: F401
    NA_TOKENS,
    clean_text,
    composite_key,
    date_attributes,
    date_key,
    day_of_week,
    flag_to_bit,
    month_key,
    null_tokens,
    parse_currency,
    parse_date,
    parse_flag,
    parse_int,
    parse_number,
    strict_bigint,
    strip_text,
)
