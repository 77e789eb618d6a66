"""The production path: warehouse tables read by name from parquet folders."""

import re

import pytest

from patronage.plans import extracts
from patronage.plans.registry import fixture_params
from patronage.operators import giving, population
from patronage.sources.testdata import testdata_tables as derive_tables
from patronage.sources.warehouse import store_tables, warehouse_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    loc = str(tmp_path_factory.mktemp("warehouse"))
    derived = derive_tables(spark, SF)
    store_tables(derived, loc)  # fiscal-year facts partitioned by year
    return derived, warehouse_tables(spark, location=loc)


EXTRACTS = ["constituent_extract", "activity_extract", "affiliation_extract", "degree_extract",
            "gift_extract", "gift_summary_extract", "relative_extract"]


@pytest.mark.parametrize("name", EXTRACTS)
def test_warehouse_tables_give_the_same_files(both, name):
    derived, stored = both
    p = fixture_params(derived)
    fn = getattr(extracts, name)
    a, b = fn(derived, p), fn(stored, p)
    assert [(f.name, f.dataType) for f in a.schema] == [(f.name, f.dataType) for f in b.schema]
    assert sorted(a.collect()) == sorted(b.collect())


def scan_filters(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_fiscal_year_prunes_partitions(both):
    _, stored = both
    p = fixture_params(stored)
    plan = scan_filters(population.population_standard(stored, p))
    assert "PartitionFilters: [isnotnull(fiscal_year" in plan and "(fiscal_year" in plan and "= 2000)" in plan
    plan = scan_filters(giving.non_annual_fund_givers(stored, p))
    assert re.search(r"PartitionFilters: \[[^\]]*\(fiscal_year#\d+ = 2000\)", plan)
    assert re.search(r"PartitionFilters: \[[^\]]*\(install_fiscal_year#\d+ = 2000\)", plan)
    # column pruning: the 21-column person dimension is read with only the
    # eight columns the block needs
    plan = scan_filters(population.population_standard(stored, p))
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "adv_constituent_d" in ln][0]
    cols = scan[scan.index("[") + 1:scan.index("]")]
    assert len(cols.split(",")) == 8 and "first_name" not in cols, cols


def test_campaign_list_prunes_all_three_facts(both):
    _, stored = both
    p = fixture_params(stored)
    plan = scan_filters(extracts.gift_summary_extract(stored, p))
    for fact in ("adv_credit_f", "adv_hh_giving_f", "adv_pledge_install_f"):
        scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and fact in ln]
        assert scans and all(re.search(r"PartitionFilters: \[[^\]]*campaign_key[^\]]*dynamicpruning", ln) for ln in scans), scans


def test_catalog_database_path(spark, both):
    """``warehouse_tables(database=...)`` reads ``{database}.{name}`` from the
    catalog (global temporary views here, so no files are written)."""
    derived, _ = both
    for name in ["adv_reportvars_d", "adv_constituent_d", "adv_donor_behavior_ps"]:
        derived[name].createOrReplaceGlobalTempView(name)
    cat = warehouse_tables(spark, database="global_temp")
    p = fixture_params(cat)
    assert sorted(population.population_standard(cat, p).collect()) == \
        sorted(population.population_standard(derived, p).collect())
