"""Run parameters.

The fiscal year lives in a key/value table in the warehouse. Joining that
table into every query (as the original SQL does) hides a missing or doubled
parameter row and blocks predicate pushdown, so it is read once, checked to be
exactly one row, and passed on as a literal. Institution-specific values
(school code, segment labels, staff exceptions) are parameters too.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, functions as F

from patronage import constants as K


@dataclass(frozen=True)
class StaffException:
    """Prospects of ``staff_cons_id`` with certain class years are not counted
    as staff-solicited. The years are exact texts (``years``) or a range
    [scy_from, scy_to] of numbers, fixed or, with ``fiscal_year_relative``,
    offsets from the fiscal year (-10, -1: the ten years before it)."""

    staff_cons_id: str
    scy_from: int | None = None
    scy_to: int | None = None
    years: tuple[str, ...] = ()
    fiscal_year_relative: bool = False

    def __post_init__(self) -> None:
        if bool(self.years) == (self.scy_from is not None and self.scy_to is not None):
            raise ValueError("a staff exception has either exact years or both ends of a range")

    def bounds(self, fiscal_year: int) -> tuple[int, int]:
        base = fiscal_year if self.fiscal_year_relative else 0
        return base + self.scy_from, base + self.scy_to


@dataclass(frozen=True)
class Params:
    fiscal_year: int
    school_code: str
    # class-year segment: scy between the first two texts gets the third as
    # its label; none: no such segment
    class_segment: tuple[str, str, str] | None
    # solicitation org code -> segment label; codes not listed have no label
    org_segment_labels: tuple[tuple[str, str], ...]
    # mail code -> scholarship status label
    mail_labels: tuple[tuple[str, str], ...]
    staff_exceptions: tuple[StaffException, ...] = field(default_factory=tuple)
    # decimal places of the pledge shares, rounded half up (0 to 10)
    share_places: int = 4

    def __post_init__(self) -> None:
        if not 0 <= self.share_places <= 10:
            raise ValueError("share_places must be 0 to 10")

    def with_fiscal_year(self, fy: int) -> "Params":
        return replace(self, fiscal_year=fy)


def read_fiscal_year(reportvars: DataFrame, var_name: str = K.FISCAL_YEAR_VAR) -> int:
    """Read the fiscal-year parameter; exactly one row must exist.

    Reads at most two rows of a tiny key/value table: a bounded lookup, not a
    collect of data.
    """
    rows = (reportvars.where(F.col("var_name") == var_name)
            .select(F.col("var_value").cast("int").alias("v")).limit(2).collect())
    if len(rows) != 1 or rows[0]["v"] is None:
        raise ValueError(f"parameter {var_name!r}: expected exactly one non-null row, "
                         f"found {len(rows)}")
    return int(rows[0]["v"])
