from salesmart.functions.cleaning import (
    broken_rules,
    guarded_decimal,
    guarded_int,
    loose_double,
    loose_int,
    money,
    not_blank,
    or_empty,
    unusable,
    us_date,
)

__all__ = [
    "broken_rules", "guarded_decimal", "guarded_int", "loose_double", "loose_int", "money",
    "not_blank", "or_empty", "unusable", "us_date",
]
