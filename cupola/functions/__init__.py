from cupola.functions.parse import (
    clean_text,
    date_day,
    date_int,
    discount_rate,
    min_spend,
    to_double,
    to_int,
)

__all__ = ["clean_text", "date_day", "date_int", "discount_rate", "min_spend", "to_double", "to_int"]
