"""Staff-solicited prospects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from patronage import constants as K
from patronage.functions import text_int
from patronage.params import Params, StaffException
from patronage.tables import Tables


def _excepted(e: StaffException, fiscal_year: int) -> Column:
    """``sol.cons_id = staff AND class year matches`` with SQL three-valued
    logic. Exact years compare as text. A class year that is not a number
    (such as 'n/a') is outside every range; a NULL class year stays unknown."""
    if e.years:
        matches = F.col("scy").isin(*e.years)
    else:
        inside = F.coalesce(text_int("scy").between(*e.bounds(fiscal_year)), F.lit(False))
        matches = F.when(F.col("scy").isNull(), F.lit(None).cast("boolean")).otherwise(inside)
    return (F.col("sol_cons_id") == F.lit(e.staff_cons_id)) & matches


def staff_solicited(t: Tables, p: Params) -> DataFrame:
    """Prospects with a current staff-solicitor assignment, one row per
    assignment (not distinct). Each exception rule removes a row when
    ``NOT (rule)`` is not true, exactly as a ``WHERE NOT (a AND b)`` clause does;
    the rules are a short parameter list compiled into one predicate, so no
    join against them is needed."""
    asn = (t.adv_assignments_f
           .where((F.col("wh_current_row") == K.CURRENT_ROW) & (F.col("solicitor_code") == K.SOLICITOR_STAFF))
           .select(F.col("constituent_key_prospect").alias("constituent_key"), "staff_key"))
    prospects = t.adv_constituent_d.select("constituent_key", "scy")
    staff = (t.adv_staff_d.where(F.col("wh_current_row") == K.CURRENT_ROW)
             .select("staff_key", F.col("constituent_key_staff").alias("sol_key")))
    solicitors = t.adv_constituent_d.select(F.col("constituent_key").alias("sol_key"),
                                            F.col("cons_id").alias("sol_cons_id"))
    rows = (asn.join(prospects, "constituent_key").join(staff, "staff_key").join(solicitors, "sol_key"))
    if p.staff_exceptions:
        keep = reduce(lambda a, b: a & b, [~_excepted(e, p.fiscal_year) for e in p.staff_exceptions])
        rows = rows.where(keep)
    return rows.select("constituent_key")
