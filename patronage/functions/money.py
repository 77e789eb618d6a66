"""Money: plain sums on the column's own scale, and the check that allows them.

Budget: a measure holds 28 digits before the point and ten behind it
(``MEASURE``), a share 27; sums and shares are exact up to there, and a larger
one is an error of the cast to it, never a wrong or missing amount.

Sums stay decimals of the input's scale, so no digit is dropped. Floating
point cannot be summed exactly and in any order alike, so a table that
delivers money as float, double or text is refused where it is loaded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Every measure is brought to this type before branches are stacked.
MEASURE = "decimal(38,10)"
MOST_PLACES = 10


def money_sum(c: Column | str) -> Column:
    """``sum(c)`` of an exact numeric column, with its scale."""
    return F.sum(c)


def share(total: Column, parts: Column, places: int) -> Column:
    """``total / parts`` rounded half up to ``places`` (at most ten), for any
    total of up to 27 digits before the point and fewer than 10^10 parts. A division of the
    whole total would keep 18 digits before the point only; so the part that
    divides evenly is divided apart from the remainder, which is small."""
    total, parts = total.cast(MEASURE), parts.cast("decimal(10,0)")
    rest = total % parts
    # one digit less than a measure, so that their sum keeps all ten places
    whole = ((total - rest) / parts).cast("decimal(37,10)")
    return (whole + (rest / parts).cast(f"decimal(20,{places})")).cast(MEASURE)


def require_exact(df: DataFrame, table: str, columns: tuple[str, ...]) -> DataFrame:
    """``df`` itself if the money columns are whole numbers or decimals of at
    most ten places; otherwise an error that says what to cast."""
    for name in columns:
        kind = df.schema[name].dataType
        exact = isinstance(kind, T.IntegralType) or (isinstance(kind, T.DecimalType) and kind.scale <= MOST_PLACES)
        if not exact:
            raise TypeError(f"{table}.{name} is {kind.simpleString()}: money must be a whole number or a decimal "
                            f"of at most {MOST_PLACES} places; cast it when the table is loaded")
    return df
