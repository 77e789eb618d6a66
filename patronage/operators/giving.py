"""Gift, credit and pledge blocks.

Facts are the largest inputs. Each block filters a fact through small code
dimensions first, then aggregates it to one row per (person or household,
year) *before* joining the population: partial (map-side) aggregation makes a
household or person holding a third of all rows cost one row per task, and the
shuffle into the population join carries aggregates instead of raw gifts.
Re-aggregating after the join keeps bag semantics exact (sums distribute over
the join's multiplicities).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from patronage import constants as K
from patronage.functions import money_sum, share
from patronage.functions.money import MEASURE
from patronage.operators import dims
from patronage.operators.population import population_standard
from patronage.params import Params
from patronage.tables import Tables



def last_gift(t: Tables, p: Params, households: DataFrame | None = None) -> DataFrame:
    """Per household, the gifts on its latest gift date with the highest
    designation key of that date, summed; of the given households only, if any
    are given.

    Written as two aggregations instead of two whole-household windows: the
    first collapses gifts to (household, day, designation) map-side, the
    second picks the lexicographic maximum with ``max_by`` (NULL dates and
    designations order lowest, so a household whose latest day has only a
    NULL designation yields no row, as the window form does; gifts without a
    household form one group of their own, as a window partition would).
    """
    hhg = (t.adv_hh_giving_f
           .join(dims.countable_gift_types(t), "gift_description_key")
           .join(dims.annual_fund_campaigns(t), "campaign_key"))
    if households is not None:
        hhg = hhg.join(households, "household_key", "left_semi")
    per_day = (hhg.groupBy("household_key", "date_key_gift", "designation_key")
               .agg(money_sum("credit_amount").alias("gift_amount")))
    order = F.struct("date_key_gift", "designation_key")
    latest = (per_day.groupBy("household_key")
              .agg(F.max_by(F.struct("date_key_gift", "designation_key", "gift_amount"), order).alias("g"))
              .select("household_key", "g.*")
              .where(F.col("date_key_gift").isNotNull() & F.col("designation_key").isNotNull()))
    cal = t.adv_calendar_dv.select(F.col("date_key").alias("date_key_gift"), "calendar_date", "fiscal_year")
    des = t.adv_designation_d.select("designation_key", "designation_ld")
    return (latest.join(cal, "date_key_gift").join(des, "designation_key")
            .select("household_key", "calendar_date", "fiscal_year", "designation_ld", "gift_amount"))


def non_annual_fund_gifts(t: Tables, p: Params) -> DataFrame:
    """``con_key`` of every countable non-annual-fund credit and active pledge
    installment in FY, one row each."""
    credits = (t.adv_credit_f.where(F.col("fiscal_year") == p.fiscal_year)
               .join(dims.countable_gift_types(t), "gift_description_key")
               .join(dims.other_campaigns(t), "campaign_key")
               .select(F.col("constituent_key_credit").alias("con_key")))
    pledges = (t.adv_pledge_install_f.where(F.col("install_fiscal_year") == p.fiscal_year)
               .join(dims.countable_pledge_types(t, (K.PLEDGE_STATUS_ACTIVE,)), "pledge_description_key")
               .join(dims.other_campaigns(t), "campaign_key")
               .select(F.col("constituent_key_pledger").alias("con_key")))
    return credits.unionByName(pledges)


def non_annual_fund_givers(t: Tables, p: Params) -> DataFrame:
    """People with a countable non-annual-fund credit or active pledge
    installment in FY (``union`` = distinct)."""
    return non_annual_fund_gifts(t, p).distinct()


def _credits_by_person_year(t: Tables, p: Params) -> DataFrame:
    lo, hi = dims.gift_window(p)
    return (t.adv_credit_f
            .join(dims.countable_gift_types(t), "gift_description_key")
            .join(dims.annual_fund_campaign_years(t, lo, hi), "campaign_key")
            .groupBy(F.col("constituent_key_credit").alias("constituent_key"), "campaign_fy")
            .agg(money_sum("credit_amount").alias("amount")))


def _cash_by_household_year(t: Tables, p: Params) -> DataFrame:
    lo, hi = dims.gift_window(p)
    return (t.adv_hh_giving_f
            .join(dims.countable_gift_types(t), "gift_description_key")
            .join(dims.annual_fund_campaign_years(t, lo, hi), "campaign_key")
            .groupBy("household_key", "campaign_fy")
            .agg(money_sum("credit_amount").alias("amount")))


def _summary_rows(joined: DataFrame, label: str) -> DataFrame:
    return (joined.groupBy("cons_id", "campaign_fy")
            .agg(money_sum("amount").alias("GiftSummary_Amount"))
            .select(F.col("cons_id").alias("Constituent_Externalid"),
                    F.col("GiftSummary_Amount").cast(MEASURE).alias("GiftSummary_Amount"),
                    F.lit(label).alias("GiftSummary_Type"),
                    F.col("campaign_fy").alias("GiftSummary_Year")))


def summary_person_credit(t: Tables, p: Params, pop: DataFrame | None = None) -> DataFrame:
    """A person's own countable annual-fund credit per campaign fiscal
    year, FY-4..FY ('Cash In - Summary')."""
    pop = population_standard(t, p) if pop is None else pop
    joined = pop.select("constituent_key", "cons_id").join(_credits_by_person_year(t, p), "constituent_key")
    return _summary_rows(joined, K.SUMMARY_PERSON_CREDIT)


def summary_household_cash(t: Tables, p: Params, pop: DataFrame | None = None) -> DataFrame:
    """The household's countable annual-fund cash per campaign fiscal
    year, FY-4..FY, reported for each population member ('Cash In')."""
    pop = population_standard(t, p) if pop is None else pop
    joined = pop.select("household_key", "cons_id").join(_cash_by_household_year(t, p), "household_key")
    return _summary_rows(joined, K.SUMMARY_HOUSEHOLD_CASH)


def _pledges_by_spouse_one(t: Tables, p: Params) -> DataFrame:
    """FY annual-fund pledges per person, for each household (``hh_key``) the
    person is spouse one of, with its spouse two if that is an alumnus."""
    pledges = (t.adv_pledge_install_f
               .join(dims.countable_pledge_types(t, K.PLEDGE_STATUSES_SUMMARY), "pledge_description_key")
               .join(dims.annual_fund_campaign_years(t, p.fiscal_year, p.fiscal_year), "campaign_key")
               .groupBy(F.col("constituent_key_pledger").alias("constituent_key"), "campaign_fy")
               .agg(money_sum(F.col("expected_amt") - F.col("install_amt_paid")).alias("balance"),
                    money_sum("expected_amt").alias("amount")))
    hhb = t.adv_household_b.select(F.col("household_key").alias("hh_key"), F.col("cons_key_sps1").alias("constituent_key"),
                                   "cons_key_sps2")
    alumni_spouse = (t.adv_constituent_d.where(F.col("primary_donor_code") == K.ALUMNI)
                     .select(F.col("constituent_key").alias("sps_key")))
    return (pledges.join(hhb, "constituent_key")
            .join(alumni_spouse, F.col("cons_key_sps2") == F.col("sps_key"), "left")
            .select("constituent_key", "hh_key", "campaign_fy", "balance", "amount", "sps_key"))


def _pledge_measures(p: Params) -> dict[str, Column]:
    """The four measures from a group's ``bal``, ``amt`` and ``n_spouses``, in
    the order of ``K.PLEDGE_MEASURES``; the shares are rounded half up to
    ``p.share_places``, at most ten, places."""
    parts = F.col("n_spouses") + 1
    columns = (F.col("bal").cast(MEASURE), F.col("amt").cast(MEASURE),
               share(F.col("bal"), parts, p.share_places), share(F.col("amt"), parts, p.share_places))
    return dict(zip(("Pledge Balance", "Pledge Amount", "Pledge Balance - Summary", "Pledge Amount - Summary"), columns))


def summary_pledges_wide(t: Tables, p: Params, pop: DataFrame | None = None) -> DataFrame:
    """FY annual-fund pledge balance and amount for people who are spouse
    one of their household, plain and divided by (alumni spouses + 1)."""
    pop = population_standard(t, p) if pop is None else pop
    joined = (pop.select("constituent_key", "household_key", "cons_id")
              .join(_pledges_by_spouse_one(t, p), "constituent_key").where("household_key = hh_key"))
    agg = (joined.groupBy("cons_id", "campaign_fy")
           .agg(money_sum("balance").alias("bal"), money_sum("amount").alias("amt"),
                F.countDistinct("sps_key").alias("n_spouses")))
    return agg.select(F.col("cons_id").alias("Constituent_Externalid"),
                      *[c.alias(name) for name, c in _pledge_measures(p).items()],
                      F.col("campaign_fy").alias("GiftSummary_Year"))


def summary_pledges_long(t: Tables, p: Params, pop: DataFrame | None = None) -> DataFrame:
    """B14 stacked long; NULL measures are dropped, as UNPIVOT does."""
    wide = summary_pledges_wide(t, p, pop)
    return (wide.unpivot(["Constituent_Externalid", "GiftSummary_Year"], list(K.PLEDGE_MEASURES),
                         "GiftSummary_Type", "GiftSummary_Amount")
            .where(F.col("GiftSummary_Amount").isNotNull())
            .select("Constituent_Externalid", "GiftSummary_Amount", "GiftSummary_Type", "GiftSummary_Year"))


def gift_summary(t: Tables, p: Params, pop: DataFrame | None = None) -> DataFrame:
    """B12, B13 and B15 in one pass: what lies by person (credits, pledges) is
    stacked and meets the population once, what lies by household (cash) meets
    it once more, and one aggregation makes all six measures. A kind without
    rows in a (person, year) gives no row; a NULL pledge measure gives none
    either, as UNPIVOT does."""
    pop = (population_standard(t, p) if pop is None else pop).select("constituent_key", "household_key", "cons_id")
    by_person = (_credits_by_person_year(t, p)
                 .select("constituent_key", "campaign_fy", F.lit("credit").alias("kind"), F.col("amount").alias("credit"))
                 .unionByName(_pledges_by_spouse_one(t, p).withColumn("kind", F.lit("pledge")), allowMissingColumns=True))
    cash = _cash_by_household_year(t, p).select("household_key", "campaign_fy", F.lit("cash").alias("kind"), F.col("amount").alias("cash"))
    of_person = (pop.join(by_person, "constituent_key")
                 .where((F.col("kind") == "credit") | (F.col("household_key") == F.col("hh_key"))))
    rows = (of_person.select("cons_id", "campaign_fy", "kind", "credit", "balance", "amount", "sps_key")
            .unionByName(pop.join(cash, "household_key").select("cons_id", "campaign_fy", "kind", "cash"), allowMissingColumns=True))
    agg = rows.groupBy("cons_id", "campaign_fy").agg(
        F.count(F.when(F.col("kind") == "credit", 1)).alias("n_credit"), money_sum("credit").alias("credit"),
        F.count(F.when(F.col("kind") == "cash", 1)).alias("n_cash"), money_sum("cash").alias("cash"),
        money_sum("balance").alias("bal"), money_sum("amount").alias("amt"), F.countDistinct("sps_key").alias("n_spouses"))

    def measure(name: str, present: Column, amount: Column) -> Column:
        return F.struct(amount.cast(MEASURE).alias("GiftSummary_Amount"), F.lit(name).alias("GiftSummary_Type"), present.alias("present"))
    pledges = [measure(name, c.isNotNull(), c) for name, c in _pledge_measures(p).items()]
    return (agg.select("cons_id", "campaign_fy", F.inline(F.array(
        measure(K.SUMMARY_PERSON_CREDIT, F.col("n_credit") > 0, F.col("credit")),
        measure(K.SUMMARY_HOUSEHOLD_CASH, F.col("n_cash") > 0, F.col("cash")), *pledges)))
        .where("present").select(F.col("cons_id").alias("Constituent_Externalid"), "GiftSummary_Amount", "GiftSummary_Type",
                                 F.col("campaign_fy").alias("GiftSummary_Year")))
