"""Column expressions. All stay in the JVM, give NULL on bad input, and work with ANSI mode on or off."""

from wardhouse.functions.dates import (
    DATE_FORMATS,
    age_band,
    birth_year,
    bucketize,
    date_from_key,
    date_key,
    elapsed_minutes,
    parse_date,
)
from wardhouse.functions.numbers import (
    human_number,
    line_amount,
    parse_int,
    parse_money,
    parse_rate,
    percent_value,
    rate_label,
    recover_price,
    recover_quantity,
    split_payment,
)
from wardhouse.functions.text import (
    clean_code,
    clean_name,
    clean_status,
    is_blank,
    standardize,
)

__all__ = [
    "DATE_FORMATS",
    "age_band",
    "birth_year",
    "bucketize",
    "clean_code",
    "clean_name",
    "clean_status",
    "date_from_key",
    "date_key",
    "elapsed_minutes",
    "human_number",
    "is_blank",
    "line_amount",
    "parse_date",
    "parse_int",
    "parse_money",
    "parse_rate",
    "percent_value",
    "rate_label",
    "recover_price",
    "recover_quantity",
    "split_payment",
    "standardize",
]
