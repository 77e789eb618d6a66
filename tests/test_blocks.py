"""Blocks and extracts on hand-made rows; expected values are written by hand."""

import datetime as dt
import re
from dataclasses import replace
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from patronage.operators import giving, solicitation
from patronage.params import Params, StaffException, read_fiscal_year
from patronage.plans import extracts

FY = 2000
P = Params(fiscal_year=FY, school_code="000100", class_segment=None, org_segment_labels=(("GG", "Org 2"),),
           mail_labels=())
RV = [("VOLUNTR_FY", FY)]


def person(key, *, scy="1990", parent_scy="n/a", code="A", hh=None, excl=-1, donor=1, deceased="N",
           last="Last", college="Last", gender="F", cons_id=None):
    return (key, 100000 + key, cons_id or f"{key:09d}", key if hh is None else hh, key, excl, donor,
            "Ms.", f"First{key}", None, last, None, f"Pref{key}", college, gender, "single",
            scy, parent_scy, code, deceased, "N")


SENTINEL = (-1, -1, "n/a", -1, -1, -1, -1) + (None,) * 9 + ("n/a", "n/a", "X", "N", "N")


def behavior(key, og=1, lyr_og=9, bf=1, lyr_bf=9, status="Never"):
    return (key, FY, status, og, lyr_og, bf, lyr_bf)


# ------------------------------------------------------------------ parameters
@pytest.mark.parametrize("rows", [[], [("VOLUNTR_FY", 2000), ("VOLUNTR_FY", 2001)]])
def test_fiscal_year_needs_exactly_one_row(make_tables, rows):
    with pytest.raises(ValueError):
        read_fiscal_year(make_tables(adv_reportvars_d=rows).adv_reportvars_d)


def test_fiscal_year_single_row(make_tables):
    assert read_fiscal_year(make_tables(adv_reportvars_d=RV + [("OTHER", 1)]).adv_reportvars_d) == FY


# ------------------------------------------------------------------ last gift
def gift_dims():
    return dict(
        adv_gift_description_d=[(0, "N", "N"), (5, "Y", "N")],
        adv_campaign_d=[(20001, "AF", 19990701), (20002, "CC", 19990701)],
        adv_designation_d=[(1, "Annual Fund"), (3, "Library"), (5, "Other")],
        adv_calendar_dv=[(d, dt.date(d // 10000, d // 100 % 100, d % 100), 2000)
                         for d in (19990701, 19991201, 20000101, 20000105, 20000201)],
    )


def test_last_gift_latest_day_then_highest_designation(make_tables):
    g = [  # household, gift, day, designation, campaign, description, pledge, amount
        (10, "G1", 20000105, 1, 20001, 0, 1, D("5.00")),
        (10, "G2", 20000105, 3, 20001, 0, 2, D("7.00")),
        (10, "G3", 20000105, 3, 20001, 0, 3, D("1.50")),
        (10, "G4", 19991201, 5, 20001, 0, 4, D("100.00")),
        # latest day has only a NULL designation: the household gets no row
        (20, "G5", 20000201, None, 20001, 0, 5, D("1.00")),
        (20, "G6", 20000101, 1, 20001, 0, 6, D("4.00")),
        # a later soft credit and a later non-annual-fund gift do not count
        (30, "G7", 20000201, 1, 20001, 5, 7, D("9.00")),
        (30, "G8", 20000105, 1, 20002, 0, 8, D("9.00")),
        (30, "G9", 19991201, 3, 20001, 0, 9, D("2.00")),
    ]
    t = make_tables(adv_hh_giving_f=g, **gift_dims())
    out = {r.household_key: r for r in giving.last_gift(t, P).collect()}
    assert set(out) == {10, 30}
    assert (out[10].calendar_date, out[10].designation_ld, out[10].gift_amount) == \
        (dt.date(2000, 1, 5), "Library", D("8.50"))
    assert (out[30].calendar_date, out[30].designation_ld, out[30].gift_amount) == \
        (dt.date(1999, 12, 1), "Library", D("2.00"))


# ------------------------------------------------------------------ gift ids
def test_gift_transaction_ids_and_null_pledge_last(make_tables):
    rows = [(10, "G", 20000105, 1, 20001, 0, n, D("1.00")) for n in range(2, 101)]
    rows.append((10, "G", 20000105, 1, 20001, 0, None, D("0.01")))
    t = make_tables(adv_reportvars_d=RV, adv_constituent_d=[person(10)],
                    adv_donor_behavior_ps=[behavior(10)], adv_hh_giving_f=rows, **gift_dims())
    out = extracts.gift_extract(t, P).collect()
    ids = sorted(r.Gift_TransactionId for r in out)
    assert len(ids) == 100 and len(set(ids)) == 100
    assert {"G01", "G09", "G99", "G#100#"} <= set(ids)
    assert all(r.Gift_Date == "01/05/2000" and r.Gift_Year == 2000 for r in out)
    # pledge numbers 2..100 take ids 01..99; the NULL pledge number sorts last
    assert [r.Gift_TransactionId for r in out if r.Gift_Amount == D("0.01")] == ["G#100#"]


# ------------------------------------------------------------------ summaries
def pledge_tables(make_tables, pledges, spouse_code="A"):
    people = [person(10, hh=10), person(11, hh=10, code=spouse_code), SENTINEL]
    return make_tables(
        adv_reportvars_d=RV, adv_constituent_d=people,
        adv_donor_behavior_ps=[behavior(10), behavior(11)],
        adv_household_b=[(10, 10, 11, "Spouse"), (10, 11, 10, "Spouse")],
        adv_pldg_description_d=[(0, "A", "N", "N")],
        adv_campaign_d=[(20001, "AF", 19990701)],
        adv_calendar_dv=[(19990701, dt.date(1999, 7, 1), 2000)],
        adv_pledge_install_f=pledges)


def test_pledge_share_divides_among_alumni_spouses(make_tables):
    t = pledge_tables(make_tables, [(10, 0, 20001, 2000, D("100.01"), D("0.00"))])
    out = {r.GiftSummary_Type: r.GiftSummary_Amount
           for r in giving.summary_pledges_long(t, P).collect()}
    assert out == {"Pledge Balance": D("100.0100"), "Pledge Amount": D("100.0100"),
                   "Pledge Balance - Summary": D("50.0050"), "Pledge Amount - Summary": D("50.0050")}
    # a spouse who is not an alumnus does not share
    t = pledge_tables(make_tables, [(10, 0, 20001, 2000, D("100.01"), D("0.00"))], spouse_code="P")
    out = {r.GiftSummary_Type: r.GiftSummary_Amount for r in giving.summary_pledges_long(t, P).collect()}
    assert out["Pledge Amount - Summary"] == D("100.0100")


def test_unpivot_drops_null_measures(make_tables):
    t = pledge_tables(make_tables, [(10, 0, 20001, 2000, None, D("0.00"))])
    assert giving.summary_pledges_long(t, P).count() == 0
    assert giving.summary_pledges_wide(t, P).count() == 1


def test_union_of_givers_is_distinct(make_tables):
    t = make_tables(
        adv_gift_description_d=[(0, "N", "N")], adv_pldg_description_d=[(0, "A", "N", "N")],
        adv_campaign_d=[(20002, "CC", 19990701)],
        adv_credit_f=[(7, 0, 20002, FY, D("1.00")), (7, 0, 20002, FY, D("2.00"))],
        adv_pledge_install_f=[(7, 0, 20002, FY, D("3.00"), D("0.00")), (8, 0, 20002, FY - 1, D("3.00"), D("0"))])
    assert [r.con_key for r in giving.non_annual_fund_givers(t, P).collect()] == [7]


# ------------------------------------------------------------------ staff exceptions
def test_staff_exception_rules(make_tables):
    people = [person(1, cons_id="000000001", scy="n/a"), person(20, scy="1995"),
              person(21, scy="1980"), person(22, scy="n/a")]
    t = make_tables(adv_constituent_d=people, adv_staff_d=[(1, 1, "Y")],
                    adv_assignments_f=[(k, 1, "Y", "STAF") for k in (20, 21, 22)] + [(20, 1, "Y", "STAF")])

    def kept(*rules, fy=FY):
        p = replace(P, fiscal_year=fy, staff_exceptions=rules)
        return sorted(r.constituent_key for r in solicitation.staff_solicited(t, p).collect())
    one = "000000001"
    assert kept(StaffException(one, 1990, 1999)) == [21, 22]  # 1995 dropped (both assignments); 1980 and 'n/a' kept
    # one rule, two fiscal years: FY-10..FY-1
    ten_years = StaffException(one, -10, -1, fiscal_year_relative=True)
    assert kept(ten_years) == [21, 22] and kept(ten_years, fy=1990) == [20, 20, 22]
    # exact years are texts
    assert kept(StaffException(one, years=("1980", "n/a"))) == [20, 20]
    assert kept(StaffException("000000009", years=("1980",))) == [20, 20, 21, 22]
    with pytest.raises(ValueError):
        StaffException(one)
    with pytest.raises(ValueError):
        StaffException(one, 1990, 1999, years=("1990",))
    assert sorted(r.constituent_key for r in solicitation.staff_solicited(t, P).collect()) == [20, 20, 21, 22]


# ------------------------------------------------------------------ wide file
def test_constituent_fan_out_streaks_and_masking(make_tables):
    people = [person(10, scy="1990", excl=1, donor=1), person(12, scy="1991", donor=2),
              person(14, scy="1992", donor=3), SENTINEL]
    t = make_tables(
        adv_reportvars_d=RV, adv_constituent_d=people,
        adv_contact_info_d=[(k, "n/a", "555", "n/a", "1 Main", "n/a", "n/a", "City", "ME", "00001",
                             "n/a", "n/a", "ME") for k in (10, 12, 14)],
        adv_donor_behavior_ps=[behavior(10, og=0, lyr_og=7), behavior(12, og=3, lyr_og=7),
                               behavior(14, og=None, lyr_og=7)],
        adv_household_b=[(k, k, -1, "n/a") for k in (10, 12, 14)],
        adv_donor_codes_d=[(1, "A", "Alumni"), (3, "T", "Trustee")],
        adv_donor_group_b=[(1, 1), (2, 1), (2, 3)],  # group 3 has no codes: person 14 is dropped
        adv_exclusion_codes_d=[(1, "DM", "No Mail"), (8, "N25", "Not Solicitable")],
        adv_exclusion_group_b=[(1, 1), (1, 8)],
        apradeg=[(100010, 1, "000100", "BA", dt.date(1990, 5, 20)), (100010, 2, "000100", "BS", dt.date(1990, 5, 20))],
        afrctyp=[(100012, "2000", D("1000.00"), "GG")])
    rows = extracts.constituent_extract(t, P).collect()
    by = {}
    for r in rows:
        by.setdefault(r.Constituent_Externalid, []).append(r)
    assert sorted(by) == ["000000010", "000000012"]
    assert len(by["000000010"]) == 2  # BA and BS
    a, b = by["000000010"][0], by["000000012"][0]
    assert a.ConsecutiveGivingYears == 7 and b.ConsecutiveGivingYears == 3
    assert a.Constituent_Restrictions == "No Mail" and a.Constituent_Selectable == "FALSE"  # N25 -> no contact
    assert b.Constituent_Affiliation == "Alumni;Trustee" and b.Constituent_Selectable == "FALSE"
    assert b.Constituent_AskAmount == D("1000.00") and b.Constituent_Segments == "Org 2"
    assert a.Spouse_Externalid is None and a.Spouse_Name is None and a.Constituent_Email is None
    assert a.NonBFGiving == "FALSE" and a.Constituent_DonorStatus is None
    assert len(rows[0]) == 50


def test_numbering_equals_the_window(spark):
    from pyspark.sql import Window
    from patronage.operators.skew import numbered
    rows = [("hot", k % 7 if k % 11 else None, k, k % 3) for k in range(400)] + \
           [("pair", 1, k // 2, 0) for k in range(200)] + \
           [("cold", 1, 5, 0), ("cold", None, 1, 0)] + \
           [(None, k % 5, k, 1) for k in range(30)]  # a NULL group
    df = spark.createDataFrame(rows, "g string, a int, b int, c int").repartition(5)
    order = ["a", "b", "c"]
    want = df.withColumn("rn", F.row_number().over(
        Window.partitionBy("g").orderBy(*[F.col(c).asc_nulls_last() for c in order])))
    got = numbered(df, "g", order, "rn")
    assert sorted(map(tuple, got.select(*df.columns, "rn").collect()), key=repr) == \
        sorted(map(tuple, want.collect()), key=repr)


def test_numbering_spreads_a_hot_group_and_a_hot_pair(spark):
    """The window's partitions are (group, range): a group or a (group, person)
    pair with nearly all rows is numbered in several ranges."""
    from patronage.operators.skew import numbered
    df = spark.range(8000).select(F.lit("G").alias("g"), F.lit(1).alias("person"), "id")
    out = numbered(df, "g", ["person", "id"], "rn")
    assert out.where("rn <> id + 1").count() == 0
    windows = re.findall(r"row_number\(\) windowspecdefinition\((\w+)#\d+, (\w+)#", out._jdf.queryExecution().optimizedPlan().toString())
    assert ("g", "__range") in windows


def test_a_null_gift_number_and_ids_beyond_99(make_tables):
    people = [person(k, hh=10) for k in range(1, 103)]
    gifts = [(10, g, 20000105, 1, 20001, 0, 1, D("5.00")) for g in ("G1", "G11", None)]
    t = make_tables(adv_constituent_d=people, adv_donor_behavior_ps=[behavior(k) for k in range(1, 103)],
                    adv_hh_giving_f=gifts, **gift_dims())
    ids = [r.Gift_TransactionId for r in extracts.gift_extract(t, P).collect()]
    assert len(ids) == len(set(ids)) == 3 * 102
    assert {"01", "99", "#100#", "G101", "G199", "G1#101#", "G1101", "G11#102#"} <= set(ids)


def test_many_staff_assignments_expand_to_as_many_rows(make_tables, monkeypatch):
    monkeypatch.setattr(extracts, "ASSIGNMENT_BLOCK", 4)
    t = make_tables(
        adv_reportvars_d=RV, adv_constituent_d=[person(k, scy="1960") for k in (1, 10, 12)] + [SENTINEL],
        adv_contact_info_d=[(k,) + ("x",) * 12 for k in (10, 12)],
        adv_donor_behavior_ps=[behavior(10), behavior(12)],
        adv_household_b=[(k, k, -1, "n/a") for k in (10, 12)],
        adv_donor_codes_d=[(1, "A", "Alumni")], adv_donor_group_b=[(1, 1)],
        adv_staff_d=[(k, 1, "Y") for k in range(9)], adv_assignments_f=[(10, k, "Y", "STAF") for k in range(9)])
    rows = extracts.constituent_extract(t, P).collect()
    assert sorted(r.Constituent_Selectable for r in rows) == ["FALSE"] * 9 + ["TRUE"]


@pytest.mark.parametrize("places", [4, 10])
def test_sums_keep_every_place(spark, places):
    from patronage.functions import money_sum
    df = spark.createDataFrame([(D("0.0050"),), (D("0.0099"),)], f"a decimal({places + 10},{places})")
    assert df.agg(money_sum("a")).first()[0] == D("0.0149")


def test_summaries_keep_every_place_and_round_shares_as_told(make_tables, schemas, spark):
    from pyspark.sql import types as T

    from patronage.tables import Tables
    people = [person(7, hh=7), person(8, hh=8), person(9, hh=7)]
    t = make_tables(adv_constituent_d=people, adv_donor_behavior_ps=[behavior(k) for k in (7, 8)],
                    adv_household_b=[(7, 7, 9, "x")], adv_pldg_description_d=[(0, "A", "N", "N")], **gift_dims())
    fine = {}
    for name, rows in (("adv_credit_f", [(7, 0, 20001, FY, D("0.0050")), (7, 0, 20001, FY, D("0.0099"))]),
                       ("adv_pledge_install_f", [(7, 0, 20001, FY, D("0.0003"), D("0.0000"))])):
        kind = T.StructType([T.StructField(f.name, T.DecimalType(18, 4) if isinstance(f.dataType, T.DecimalType) else f.dataType)
                             for f in schemas[name].fields])
        fine[name] = spark.createDataFrame(rows, kind)
    tables = Tables({n: (lambda n=n: fine.get(n, t[n])) for n in t.names()})
    assert [r.GiftSummary_Amount for r in giving.summary_person_credit(tables, P).collect()] == [D("0.0149")]
    wide = giving.summary_pledges_wide(tables, P).first()
    assert wide["Pledge Amount"] == D("0.0003") and wide["Pledge Amount - Summary"] == D("0.0002")  # half up
    wide = giving.summary_pledges_wide(tables, replace(P, share_places=6)).first()
    assert wide["Pledge Amount - Summary"] == D("0.000150")


def test_money_that_is_not_exact_is_refused_at_load(spark, schemas):
    from patronage.tables import Tables
    bad = spark.createDataFrame([], schemas["adv_credit_f"]).withColumn("credit_amount", F.lit(0.29))
    with pytest.raises(TypeError, match="adv_credit_f.credit_amount is double"):
        Tables({"adv_credit_f": lambda: bad})["adv_credit_f"]


# ------------------------------------------------------------------ populations
def test_parent_year_is_numeric_and_alumni_year_textual(make_tables):
    from patronage.operators.population import population_constituent, population_standard
    people = [person(1, code="P", parent_scy="n/a"), person(2, code="P", parent_scy="1999"),
              person(3, code="P", parent_scy="2000"), person(4, code="P", parent_scy="n/a"),
              person(5, code="A", scy="n/a"), person(6, code="A", scy="1929"), person(7, code="A", scy="1930")]
    beh = [behavior(k) for k in (1, 2, 3, 5, 6, 7)] + [behavior(4, status="Lybunt")]
    t = make_tables(adv_constituent_d=people, adv_donor_behavior_ps=beh)
    for block in (population_standard, population_constituent):
        assert sorted(r.constituent_key for r in block(t, P).collect()) == [3, 4, 5, 7]


def test_streak_fallback_and_last_gift_masking(make_tables):
    # person 10 trustee, 12 top prospect, 14 neither, 16 no ask row (org NULL)
    keys = (10, 12, 14, 16)
    people = [person(k, scy="1990", donor=(2 if k == 10 else 1), hh=k) for k in keys] + [SENTINEL]
    g = [(k, f"G{k}", 20000105, 1, 20001, 0, k, D("10.00")) for k in keys]
    t = make_tables(
        adv_reportvars_d=RV, adv_constituent_d=people,
        adv_contact_info_d=[(k,) + ("x",) * 12 for k in keys],
        adv_donor_behavior_ps=[behavior(10, og=0, lyr_og=7, bf=0, lyr_bf=None), behavior(12, og=3, lyr_og=7),
                               behavior(14, og=None, lyr_og=7), behavior(16)],
        adv_household_b=[(k, k, -1, "n/a") for k in keys],
        adv_donor_codes_d=[(1, "A", "Alumni"), (3, "T", "Trustee")],
        adv_donor_group_b=[(1, 1), (2, 1), (2, 3)],
        afrctyp=[(100012, "2000", D("1.00"), "TP"), (100014, "2000", D("1.00"), "GG")],
        adv_hh_giving_f=g, **gift_dims())
    out = {r.Constituent_Externalid: r for r in extracts.constituent_extract(t, P).collect()}
    assert [out[f"{k:09d}"].ConsecutiveGivingYears for k in keys] == [7, 3, None, 1]
    assert out["000000010"].ConsecGivingYearsBF is None  # 0 falls back to a NULL last-year streak
    masked = [out[f"{k:09d}"].Constituent_LastGiftAmount for k in keys]
    assert masked == [None, None, D("10.00"), D("10.00")]
    assert out["000000014"].Constituent_LastGiftDate == "01/05/2000"
    assert out["000000014"].LastGiftDesignation == "Annual Fund"
    assert [out[f"{k:09d}"].Constituent_Selectable for k in keys] == ["FALSE", "FALSE", "TRUE", "TRUE"]


def test_equal_and_different_side_rows_fan_out_as_the_joins_do(make_tables, monkeypatch):
    """Three asks (two equal), two employments, a degree twice, one mail code
    three times and two staff assignments: 3 x 2 x 2 x 3 x 2 rows."""
    monkeypatch.setattr(extracts, "ASSIGNMENT_BLOCK", 5)
    pidm = 100010
    t = make_tables(
        adv_reportvars_d=RV, adv_constituent_d=[person(k, scy="1960") for k in (1, 10, 12)] + [SENTINEL],
        adv_contact_info_d=[(k,) + ("x",) * 12 for k in (10, 12)],
        adv_donor_behavior_ps=[behavior(10), behavior(12)],
        adv_household_b=[(k, k, -1, "n/a") for k in (10, 12)] + [(99, 10, -1, "another household")],
        adv_donor_codes_d=[(1, "A", "Alumni")], adv_donor_group_b=[(1, 1)],
        adv_staff_d=[(k, 1, "Y") for k in range(2)], adv_assignments_f=[(10, k, "Y", "STAF") for k in range(2)],
        afrctyp=[(pidm, str(FY), D("5.00"), "GG"), (pidm, str(FY), D("5.00"), "GG"), (pidm, str(FY), None, "XX"),
                 (pidm, "n/a", D("7.00"), "GG")],
        aprehis=[(pidm, "Y", None, None, 100012, "one", None), (pidm, "Y", None, None, None, "two", "Elsewhere"), (pidm, "N", None, None, None, "no", None)],
        apradeg=[(pidm, k, "000100", "BA", None) for k in (1, 2)],
        aprmail=[(pidm, "SIO")] * 3 + [(None, "SIO")])
    rows = extracts.constituent_extract(t, P).collect()
    mine = [r for r in rows if r.Constituent_Externalid == "000000010"]
    assert len(mine) == 3 * 2 * 2 * 3 * 2 and len(rows) == len(mine) + 1
    assert sum(r.Constituent_AskAmount is None for r in mine) == len(mine) // 3
    assert {(r.Business_JobTitle, r.Business_Employer) for r in mine} == {("one", "Last"), ("two", "Elsewhere")}
    assert {r.Spouse_Name for r in mine} == {None}


def test_shares_are_exact_for_every_measure(spark):
    from decimal import ROUND_HALF_UP, localcontext

    from patronage.functions import share
    amounts = ["0.00", "0.01", "-0.01", "0.05", "10.00", "-10.00", "1000000000000000000.01", "999999999999999999999999999.4949",
               "-123456789012345678901234567.0000000005", None]
    rows = [(a and D(a), n) for a in amounts for n in (1, 2, 3, 7)]
    df = spark.createDataFrame(rows, "a decimal(38,10), n int")
    for places in (2, 4, 10):
        for a, n, got in df.select("a", "n", share(F.col("a"), F.col("n"), places)).collect():
            with localcontext() as c:
                c.prec = 60
                assert got == (a if a is None else (a / n).quantize(D(1).scaleb(-places), ROUND_HALF_UP)), (a, n)
    over = spark.createDataFrame([(D("1e30"),)], "a decimal(38,0)")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        over.select(share(F.col("a"), F.lit(2), 4)).collect()
