"""A lazy, named set of input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from patronage.functions.money import require_exact

# The 32 warehouse tables the extracts read.
TABLE_NAMES = (
    "adv_reportvars_d", "adv_constituent_d", "adv_household_b", "adv_contact_info_d",
    "adv_donor_behavior_ps", "adv_calendar_dv", "adv_campaign_d", "adv_gift_description_d",
    "adv_designation_d", "adv_hh_giving_f", "adv_credit_f", "adv_pldg_description_d",
    "adv_pledge_install_f", "adv_donor_codes_d", "adv_donor_group_b", "adv_exclusion_codes_d",
    "adv_exclusion_group_b", "adv_assignments_f", "adv_staff_d", "aprxref", "aprpros",
    "apracty", "apracyr", "stvactc", "stvactp", "apradeg", "apramaj", "stvmajr", "afrctyp",
    "atvsicc", "aprehis", "aprmail",
)


# Columns that are summed: they must be exact numbers.
MONEY_COLUMNS = {
    "adv_hh_giving_f": ("credit_amount",), "adv_credit_f": ("credit_amount",),
    "adv_pledge_install_f": ("expected_amt", "install_amt_paid"), "afrctyp": ("afrctyp_ask_amount",),
}


class Tables:
    """Maps table name -> DataFrame, building each one on first use."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name not in self._builders:
                raise KeyError(f"unknown table {name!r}")
            df = self._builders[name]()
            self._cache[name] = require_exact(df, name, MONEY_COLUMNS.get(name, ()))
        return self._cache[name]

    def names(self) -> list[str]:
        return sorted(self._builders)
