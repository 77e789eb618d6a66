"""Built-in Spark expressions reproducing the source SQL dialect's rules.

The source dialect treats the empty string as NULL, lets ``||`` ignore NULLs,
sorts NULLs last and converts text to numbers implicitly. Spark differs on all
four, so every such use goes through one of these helpers. All of them are
plain Catalyst expressions (whole-stage codegen, no Python at run time).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_token(c: Column | str, token: str) -> Column:
    """Two-argument ``replace``: remove ``token`` anywhere; an empty result is NULL."""
    return F.nullif(F.replace(_c(c), F.lit(token), F.lit("")), F.lit(""))


def cat(*parts: Column | str) -> Column:
    """``a || b || ...`` where NULL operands count as empty text.

    String literals are passed as ``F.lit``; bare strings are column names.
    """
    return F.concat(*[F.coalesce(_c(p), F.lit("")) for p in parts])


def decode(c: Column | str, pairs: Iterable[tuple[str, str]],
           default: Column | None = None) -> Column:
    """Simple ``CASE c WHEN k THEN v ... [ELSE default] END`` (NULL matches nothing)."""
    col = _c(c)
    out = None
    for key, value in pairs:
        out = (F.when(col == F.lit(key), F.lit(value)) if out is None
               else out.when(col == F.lit(key), F.lit(value)))
    if out is None:
        return default if default is not None else F.lit(None).cast("string")
    return out.otherwise(default) if default is not None else out


def true_false(cond: Column) -> Column:
    """``CASE WHEN cond THEN 'TRUE' ELSE 'FALSE' END`` (unknown gives 'FALSE')."""
    return F.when(cond, F.lit("TRUE")).otherwise(F.lit("FALSE"))


def text_int(c: Column | str) -> Column:
    """Explicit text-to-number conversion; unparsable text such as 'n/a' is NULL."""
    return _c(c).try_cast("int")


def mmddyyyy(c: Column | str) -> Column:
    return F.date_format(_c(c), "MM/dd/yyyy")


def yyyy(c: Column | str) -> Column:
    return F.date_format(_c(c), "yyyy")


def sequence_suffix(c: Column | str) -> Column:
    """Two digits up to 99; from 100 on, where two digits overflow, the number
    between ``#`` signs. Read from its right end a suffix is unambiguous after
    any text, so different (text, number) pairs never give one id."""
    n = _c(c)
    return F.when(n < 100, F.format_string("%02d", n)).otherwise(F.format_string("#%d#", n))


def ordered_listagg(value_col: str, sep: str, *order_cols: str) -> Column:
    """``listagg(value, sep) WITHIN GROUP (ORDER BY ...)`` with NULLs last.

    NULL values are skipped and an all-NULL group gives NULL. Arguments are
    column names of the aggregated DataFrame (project expressions first).
    """
    def q(name: str) -> str:
        return "`" + name.replace("`", "``") + "`"
    esc = sep.replace("\\", "\\\\").replace("'", "\\'")
    order = ", ".join(f"{q(o)} ASC NULLS LAST" for o in order_cols)
    return F.expr(f"listagg({q(value_col)}, '{esc}') WITHIN GROUP (ORDER BY {order})")
