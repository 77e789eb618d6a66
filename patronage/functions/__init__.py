"""Column expressions with the warehouse's text and NULL semantics, and money sums."""

from patronage.functions.money import money_sum, share
from patronage.functions.text import (
    cat,
    decode,
    mmddyyyy,
    ordered_listagg,
    sequence_suffix,
    strip_token,
    text_int,
    true_false,
    yyyy,
)

__all__ = ["money_sum", "cat", "decode", "mmddyyyy", "ordered_listagg", "sequence_suffix", "share", "strip_token",
           "text_int", "true_false", "yyyy"]
