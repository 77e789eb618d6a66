"""Named queries: every extract and building block, runnable on test data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from patronage.operators import giving, population, rollups, solicitation
from patronage.params import Params, StaffException, read_fiscal_year
from patronage.plans import extracts
from patronage.sources.testdata import testdata_tables
from patronage.tables import Tables

Block = Callable[[Tables, Params], DataFrame]

QUERIES: dict[str, Block] = {
    # the seven extract files
    "constituent_extract": extracts.constituent_extract,
    "activity_extract": extracts.activity_extract,
    "affiliation_extract": extracts.affiliation_extract,
    "degree_extract": extracts.degree_extract,
    "gift_extract": extracts.gift_extract,
    "gift_summary_extract": extracts.gift_summary_extract,
    "relative_extract": extracts.relative_extract,
    # building blocks
    "population_standard": population.population_standard,
    "population_first_year": population.population_first_year,
    "population_constituent": population.population_constituent,
    "first_year_parents": population.first_year_parents,
    "last_gift": giving.last_gift,
    "exclusion_rollup": rollups.exclusion_rollup,
    "affiliation_rollup": rollups.affiliation_rollup,
    "non_annual_fund_givers": giving.non_annual_fund_givers,
    "staff_solicited": solicitation.staff_solicited,
    "student_activities": rollups.student_activities,
    "student_info": rollups.student_info,
    "summary_person_credit": giving.summary_person_credit,
    "summary_household_cash": giving.summary_household_cash,
    "summary_pledges_wide": giving.summary_pledges_wide,
    "summary_pledges_long": giving.summary_pledges_long,
}

# Parameters for the driver's test data: the school code its degree rows use
# and staff exception rules that hit, miss and meet 'n/a' class years.
FIXTURE_SCHOOL_CODE = "000100"
FIXTURE_STAFF_EXCEPTIONS = (
    StaffException("000000001", 1920, 1960),
    StaffException("000000002", 1961, 2005),
    StaffException("000000005", -10, -1, fiscal_year_relative=True),
    StaffException("000000006", years=("1970", "1985", "n/a")),
)
# Neutral labels; one holds a quote, and one code that occurs has none.
FIXTURE_CLASS_SEGMENT = ("1960", "1969", "Class segment")
FIXTURE_ORG_LABELS = (("TP", "Org 1"), ("GG", "Org '2'"), ("XX", "Org 3"))
FIXTURE_MAIL_LABELS = (("SIO", "Mail 1"), ("SIB", "Mail 2"))


def fixture_params(t: Tables) -> Params:
    return Params(fiscal_year=read_fiscal_year(t.adv_reportvars_d),
                  school_code=FIXTURE_SCHOOL_CODE,
                  class_segment=FIXTURE_CLASS_SEGMENT,
                  org_segment_labels=FIXTURE_ORG_LABELS,
                  mail_labels=FIXTURE_MAIL_LABELS,
                  staff_exceptions=FIXTURE_STAFF_EXCEPTIONS)


def comparable(df: DataFrame) -> DataFrame:
    """Engine-neutral presentation for result comparison: exact decimals as
    double, dates as ISO text. Names and row multiset are unchanged."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


_TABLES: dict[tuple[str, str], Tables] = {}


def tables_for(spark: SparkSession, sf_dir: str) -> Tables:
    """The test-data table definitions, built once per session and folder.

    They are lazy plans, so sharing them between queries shares no data:
    every query still reads and derives everything from the parquet files.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TABLES:
        _TABLES[key] = testdata_tables(spark, sf_dir)
    return _TABLES[key]


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables_for(spark, sf_dir)
    return QUERIES[name](t, fixture_params(t))


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(run(name, spark, sf_dir))
    q.__name__ = name
    return q
