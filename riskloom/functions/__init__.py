from riskloom.functions.numbers import exact_mean, exact_std, fixed_point, square, whole_number
from riskloom.functions.order import ascending, descending
from riskloom.functions.text import key_text, join_keys, label_lookup, percent_text
from riskloom.functions.time import epoch_seconds

__all__ = [
    "ascending", "descending", "epoch_seconds", "exact_mean", "exact_std", "fixed_point", "join_keys", "key_text",
    "label_lookup", "percent_text", "square", "whole_number",
]
