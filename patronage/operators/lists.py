"""Ordered text lists whose groups may be of any size.

One ``listagg`` per group sorts and gathers the whole group in one task. Here
the group is first cut into ranges of its order key: a range holds at most
``WIDTH`` consecutive whole-number keys, so a hot group is as many range lists
as its keys need, made by different tasks. The second aggregation joins the
finished range lists in range order; it sees one short row per range, never
the group's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from patronage.functions import ordered_listagg

# Consecutive order keys (a power of two) that one range list may hold.
WIDTH = 1 << 13


def ordered_lists(rows: DataFrame, group: str, order_key: str, lists: dict[str, tuple[str, str]],
                  width: int = WIDTH) -> DataFrame:
    """Per ``group``: for every ``out: (value column, separator)`` the values
    in the order of ``order_key`` (a whole number, NULLs last), then value.

    NULL values are skipped, a list without values is NULL, a NULL group is a
    group. Equal to one ``listagg`` per group: a range's keys all lie before
    the next range's, and rows that share a key share a range.
    """
    if width & (width - 1) or width < 1:
        raise ValueError("width must be a power of two")
    in_range = rows.groupBy(group, F.shiftright(order_key, width.bit_length() - 1).alias("__range")).agg(
        *[ordered_listagg(value, sep, order_key, value).alias(out) for out, (value, sep) in lists.items()])
    return in_range.groupBy(group).agg(
        *[ordered_listagg(out, sep, "__range").alias(out) for out, (_, sep) in lists.items()])
