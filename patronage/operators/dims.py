"""Filtered dimension lookups shared by several blocks.

These are code tables (gift descriptions, campaigns, calendar days). None is
hinted for broadcast: adaptive execution broadcasts them when their runtime
size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and falls back
to a shuffle join otherwise, so a larger-than-expected dimension cannot
exhaust executor memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from patronage import constants as K
from patronage.params import Params
from patronage.tables import Tables


def countable_gift_types(t: Tables) -> DataFrame:
    """Gift descriptions that are neither soft credits nor anonymous."""
    return (t.adv_gift_description_d
            .where((F.col("soft_credit_ind") == K.NOT_FLAGGED) & (F.col("anon_ind") == K.NOT_FLAGGED))
            .select("gift_description_key"))


def countable_pledge_types(t: Tables, statuses: tuple[str, ...]) -> DataFrame:
    return (t.adv_pldg_description_d
            .where((F.col("soft_credit_ind") == K.NOT_FLAGGED) & (F.col("anon_ind") == K.NOT_FLAGGED)
                   & F.col("pledge_status_sd").isin(*statuses))
            .select(F.col("pldg_description_key").alias("pledge_description_key")))


def annual_fund_campaign_years(t: Tables, first_fy: int, last_fy: int) -> DataFrame:
    """Annual-fund campaigns established in fiscal years [first_fy, last_fy],
    with that fiscal year (campaign -> establishing calendar day)."""
    cam = (t.adv_campaign_d.where(F.col("campaign_type_sd") == K.ANNUAL_FUND)
           .select("campaign_key", "date_key_est"))
    cal = (t.adv_calendar_dv.where(F.col("fiscal_year").between(first_fy, last_fy))
           .select(F.col("date_key").alias("date_key_est"), F.col("fiscal_year").alias("campaign_fy")))
    return cam.join(cal, "date_key_est").select("campaign_key", "campaign_fy")


def annual_fund_campaigns(t: Tables) -> DataFrame:
    return t.adv_campaign_d.where(F.col("campaign_type_sd") == K.ANNUAL_FUND).select("campaign_key")


def other_campaigns(t: Tables) -> DataFrame:
    return t.adv_campaign_d.where(F.col("campaign_type_sd") != K.ANNUAL_FUND).select("campaign_key")


def gift_window(p: Params) -> tuple[int, int]:
    return p.fiscal_year - K.GIFT_YEARS_WINDOW, p.fiscal_year
