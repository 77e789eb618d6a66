"""Invariants on the driver's test data (sf0.01)."""

from pyspark.sql import functions as F

from patronage.operators import giving
from patronage.plans import extracts
from patronage.plans.registry import fixture_params
from patronage.sources.testdata import testdata_tables as derive_tables

SF = "/root/testdata/sf0.01"


def test_summary_is_the_union_of_its_parts(spark):
    t = derive_tables(spark, SF)
    p = fixture_params(t)
    whole = extracts.gift_summary_extract(t, p)
    parts = [giving.summary_person_credit(t, p), giving.summary_household_cash(t, p),
             giving.summary_pledges_long(t, p)]
    assert whole.count() == sum(x.count() for x in parts)
    total = lambda df: df.agg(F.sum("GiftSummary_Amount")).first()[0]
    assert total(whole) == sum(total(x) for x in parts)


def test_one_last_gift_per_household_and_unique_gift_ids(spark):
    t = derive_tables(spark, SF)
    p = fixture_params(t)
    lg = giving.last_gift(t, p)
    assert lg.count() == lg.select("household_key").distinct().count()
    ids = extracts.gift_extract(t, p).select("Gift_TransactionId")
    assert ids.count() == ids.distinct().count()


def test_every_selectability_outcome_occurs(spark):
    t = derive_tables(spark, SF)
    out = {r[0] for r in extracts.constituent_extract(t, fixture_params(t))
           .select("Constituent_Selectable").distinct().collect()}
    assert out == {"TRUE", "FALSE"}
