"""Who is in the file: the population blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from patronage import constants as K
from patronage.functions import strip_token, text_int
from patronage.params import Params
from patronage.tables import Tables

POPULATION_COLUMNS = ("constituent_key", "household_key", "pidm", "cons_id",
                      "donor_group_key", "scy", "parent_scy")


def first_year_parents(t: Tables, p: Params) -> DataFrame:
    """Parents (by PAR edge) of students coded with the advancement interest,
    whose parent class year is FY+3. Distinct constituent keys (B4)."""
    interest = (t.aprpros
                .where((F.col("aprpros_prtp_code") == K.PROSPECT_INTEREST_TYPE)
                       & (F.col("aprpros_prcd_code") == K.PROSPECT_INTEREST_CODE))
                .select(F.col("aprpros_pidm").alias("stu_pidm")))
    students = t.adv_constituent_d.select(F.col("pidm").alias("stu_pidm"))
    edges = (t.aprxref.where(F.col("aprxref_xref_code") == K.PARENT_EDGE)
             .select(F.col("aprxref_pidm").alias("stu_pidm"), F.col("aprxref_xref_pidm").alias("par_pidm")))
    parents = (t.adv_constituent_d
               .where(F.col("parent_scy") == F.lit(str(p.fiscal_year + K.FIRST_YEAR_PARENT_OFFSET)))
               .select(F.col("pidm").alias("par_pidm"), "constituent_key"))
    # the result is distinct, so the student lookup only tests existence
    return (interest.join(students, "stu_pidm", "left_semi")
            .join(edges, "stu_pidm")
            .join(parents, "par_pidm")
            .select("constituent_key").distinct())


def _people_in_year(t: Tables, p: Params, extra: tuple[str, ...] = ()) -> DataFrame:
    """Person dimension joined to its behavior snapshot of fiscal year FY."""
    con = t.adv_constituent_d.select(*POPULATION_COLUMNS, "primary_donor_code",
                                     *[c for c in extra if c not in POPULATION_COLUMNS])
    db = (t.adv_donor_behavior_ps.where(F.col("fiscal_year") == p.fiscal_year)
          .drop("fiscal_year"))
    return con.join(db, "constituent_key")


def _alumni(p: Params) -> Column:
    # text comparison on purpose: 'n/a' sorts after every year and qualifies
    return ((F.col("primary_donor_code") == K.ALUMNI)
            & (F.col("scy") >= F.lit(str(p.fiscal_year - K.ALUMNI_YEARS_BACK))))


def standard_predicate(p: Params) -> Column:
    """Alumni of the last 70 class years, or parents who are current
    (numeric parent class year >= FY) or hold a giving status."""
    parent = ((F.col("primary_donor_code") == K.PARENT)
              & ((text_int("parent_scy") >= F.lit(p.fiscal_year))
                 | F.col("og_donor_status").isin(*K.PARENT_STATUSES)))
    return _alumni(p) | parent


def constituent_predicate(p: Params) -> Column:
    """The wide file's inline form: 'n/a' is stripped before the numeric test."""
    parent = ((F.col("primary_donor_code") == K.PARENT)
              & ((text_int(strip_token("parent_scy", K.NOT_APPLICABLE)) >= F.lit(p.fiscal_year))
                 | F.col("og_donor_status").isin(*K.PARENT_STATUSES)))
    return _alumni(p) | parent


def population_standard(t: Tables, p: Params) -> DataFrame:
    """B1: the population of the activity, degree, gift, summary and relative files."""
    return _people_in_year(t, p).where(standard_predicate(p)).select(*POPULATION_COLUMNS)


def population_first_year(t: Tables, p: Params) -> DataFrame:
    """B2: the affiliation file's population; first-year parents replace the
    current-parent test, and its status list spells 'Partial Pledger'."""
    fyp = first_year_parents(t, p).select(F.col("constituent_key").alias("fyp_key"))
    people = _people_in_year(t, p)
    parent = ((F.col("primary_donor_code") == K.PARENT)
              & (F.col("fyp_key").isNotNull()
                 | F.col("og_donor_status").isin(*K.PARENT_STATUSES_AFFILIATION)))
    return (people.join(fyp, people.constituent_key == fyp.fyp_key, "left")
            .where(_alumni(p) | parent).select(*POPULATION_COLUMNS))


def population_constituent(t: Tables, p: Params, person_extra: tuple[str, ...] = (),
                           behavior: tuple[str, ...] = ()) -> DataFrame:
    """The wide file's population, optionally with more person columns and
    columns of the FY behavior snapshot."""
    cols = list(POPULATION_COLUMNS) + [c for c in person_extra if c not in POPULATION_COLUMNS]
    return (_people_in_year(t, p, person_extra).where(constituent_predicate(p))
            .select(*cols, *behavior))
