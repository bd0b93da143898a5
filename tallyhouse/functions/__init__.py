from tallyhouse.functions.dates import days_between_bounds, month_start
from tallyhouse.functions.keys import double_text, packed_key, surrogate_key, unpacked_key
from tallyhouse.functions.money import cents, money_sum, percent_of, round_half_away
from tallyhouse.functions.text import blank_to_null, strip_whitespace

__all__ = [
    "blank_to_null",
    "cents",
    "days_between_bounds",
    "double_text",
    "money_sum",
    "month_start",
    "packed_key",
    "percent_of",
    "round_half_away",
    "strip_whitespace",
    "surrogate_key",
    "unpacked_key",
]
