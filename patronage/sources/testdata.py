"""Derive the 32 warehouse tables from the driver's TPC-H-like test data.

The mapping is documented in FIXTURES.md (section 3); the DuckDB oracle builds
the same tables with its own SQL (``patronage.checks.fixtures_sql``), so the
adapter is checked together with the extracts. Every derived table is a
linear function of the inputs (generators, not cross joins; no pairs within
a group), so the extracts' work grows with the test data. The code tables
(designations, campaign types, ...) are small literal dimensions, as in a
real warehouse.

Projections are written as SQL expression strings (``selectExpr``): one
round trip to the JVM per projection instead of one per expression node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patronage.tables import Tables

CAMPAIGN_YEARS = list(range(1995, 2003))


def literal_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small literal table as an inline VALUES relation.

    Unlike ``createDataFrame`` (an RDD scan with unknown size), an inline
    table carries exact statistics, so joins against it are planned as
    broadcast joins up front.
    """
    names = [f.strip().split()[0] for f in ddl.split(",")]
    types = [f.strip().split(None, 1)[1] for f in ddl.split(",")]

    def lit(v, t):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"CAST({v} AS {t})"

    values = ", ".join("(" + ", ".join(lit(v, t) for v, t in zip(r, types)) + ")" for r in rows)
    casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in zip(names, types))
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({', '.join(names)})")


CONSTITUENT = [
    "c_custkey AS constituent_key",
    "100000 + c_custkey AS pidm",
    "lpad(CAST(c_custkey AS STRING), 9, '0') AS cons_id",
    "c_custkey - c_custkey % 2 AS household_key",
    "c_custkey AS contact_info_key",
    "c_custkey % 40 AS exclusion_group_key",
    "c_custkey % 12 AS donor_group_key",
    "CASE c_custkey % 3 WHEN 0 THEN 'Mr.' WHEN 1 THEN 'Ms.' END AS prefix",
    "concat('First', CAST(c_custkey % 97 AS STRING)) AS first_name",
    "CASE WHEN c_custkey % 2 = 0 THEN 'M.' END AS middle_name",
    "CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE concat('Last', CAST(c_custkey % 211 AS STRING)) END AS last_name",
    "CASE WHEN c_custkey % 50 = 0 THEN 'Jr.' END AS suffix",
    "concat('Pref', CAST(c_custkey % 97 AS STRING)) AS pref_first_name",
    "concat('Last', CAST(c_custkey % (CASE WHEN c_custkey % 7 = 0 THEN 101 ELSE 211 END) AS STRING))"
    " AS college_last_name",
    "CASE c_custkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'N' END AS gender",
    "c_mktsegment AS marital_desc",
    "CASE WHEN c_custkey % 5 <= 2 THEN CAST(1920 + c_custkey % 86 AS STRING) ELSE 'n/a' END AS scy",
    "CASE WHEN c_custkey % 5 = 3 AND c_custkey % 3 <> 0 THEN CAST(1990 + c_custkey % 16 AS STRING)"
    " ELSE 'n/a' END AS parent_scy",
    "CASE WHEN c_custkey % 5 IN (0, 1, 4) THEN 'A' WHEN c_custkey % 5 = 2 THEN 'S' ELSE 'P' END"
    " AS primary_donor_code",
    "CASE WHEN c_custkey % 13 = 0 THEN 'Y' ELSE 'N' END AS deceased_ind",
    "CASE WHEN c_custkey % 4 = 0 THEN 'Y' ELSE 'N' END AS is_mg_company",
]
CONSTITUENT_DDL = (
    "constituent_key bigint, pidm bigint, cons_id string, household_key bigint, "
    "contact_info_key bigint, exclusion_group_key bigint, donor_group_key bigint, "
    "prefix string, first_name string, middle_name string, last_name string, suffix string, "
    "pref_first_name string, college_last_name string, gender string, marital_desc string, "
    "scy string, parent_scy string, primary_donor_code string, deceased_ind string, "
    "is_mg_company string")

CAMPAIGN_KEY = "CAST(fy * 10 + CASE WHEN {open} THEN 2 ELSE 1 END AS INT) AS campaign_key"


def testdata_tables(spark: SparkSession, sf_dir: str) -> Tables:
    scans: dict[str, DataFrame] = {}

    def raw(name: str) -> DataFrame:
        # one scan node per input file: listed and footer-read once per plan
        if name not in scans:
            scans[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return scans[name]

    def lit_df(rows, ddl):
        return literal_table(spark, rows, ddl)

    t: dict = {}
    t["adv_reportvars_d"] = lambda: lit_df([("VOLUNTR_FY", 2000), ("OTHER_VAR", 1)],
                                           "var_name string, var_value int")

    def constituent() -> DataFrame:
        people = raw("customer").selectExpr(*CONSTITUENT)
        # the warehouse's "n/a" person that unmarried people point at as spouse 2
        sentinel = lit_df([(-1, -1, "n/a", -1, -1, -1, -1) + (None,) * 9 + ("n/a", "n/a", "X", "N", "N")],
                          CONSTITUENT_DDL)
        return people.unionByName(sentinel)

    t["adv_constituent_d"] = constituent
    t["adv_household_b"] = lambda: tables.adv_constituent_d.where("constituent_key >= 0").selectExpr(
        "household_key", "constituent_key AS cons_key_sps1",
        "CASE WHEN household_key % 3 = 0 THEN CAST(-1 AS BIGINT) WHEN constituent_key % 2 = 0 "
        "THEN constituent_key + 1 ELSE constituent_key - 1 END AS cons_key_sps2",
        "CASE WHEN household_key % 3 = 0 THEN 'n/a' ELSE concat('Spouse', CAST(constituent_key AS STRING)) END"
        " AS spouse_name")

    def contact() -> DataFrame:
        cust = raw("customer").select("c_custkey", "c_nationkey")
        nation = raw("nation").select("n_nationkey", "n_name")
        return cust.join(nation, cust.c_nationkey == nation.n_nationkey).selectExpr(
            "c_custkey AS contact_info_key",
            "CASE WHEN c_custkey % 4 = 0 THEN 'n/a' ELSE concat('c', CAST(c_custkey AS STRING), '@example.org') END"
            " AS pref_email",
            "CASE WHEN c_custkey % 3 = 0 THEN 'n/a' ELSE concat('555-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0'))"
            " END AS home_phone",
            "'n/a' AS cell_primary", "concat(CAST(c_custkey AS STRING), ' Main St') AS pref_mail_street1",
            "'n/a' AS pref_mail_street2", "'n/a' AS pref_mail_street3",
            "concat('City', CAST(c_nationkey AS STRING)) AS pref_mail_city", "'ME' AS pref_mail_state_code",
            "lpad(CAST(c_custkey % 100000 AS STRING), 5, '0') AS pref_mail_zip",
            "CASE WHEN c_custkey % 9 = 0 THEN 'n/a' ELSE n_name END AS pref_mail_nation_desc",
            "'n/a' AS work_city", "'ME' AS work_state_code")

    t["adv_contact_info_d"] = contact
    # one snapshot row per person and fiscal year (a generator, not a join)
    t["adv_donor_behavior_ps"] = lambda: raw("customer").selectExpr(
        "c_custkey AS constituent_key", "explode(array(1999, 2000)) AS fiscal_year",
        "CASE c_custkey % 7 WHEN 0 THEN 'Donor' WHEN 1 THEN 'Pledger' WHEN 2 THEN 'Partial_Pledger' "
        "WHEN 3 THEN 'Lybunt' WHEN 4 THEN 'Sybunt2' WHEN 5 THEN 'Partial Pledger' ELSE 'Never' END"
        " AS og_donor_status",
        "c_custkey % 4 AS og_consec_yrs_giving", "c_custkey % 6 AS lyr_og_consec_yrs_giving",
        "c_custkey % 3 AS bf_consec_yrs_giving", "c_custkey % 5 AS lyr_bf_consec_yrs_giving")
    t["gift_base"] = lambda: raw("orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "CAST(o_orderdate AS DATE) AS d",
        "CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INT) AS date_key",
        "CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 7 THEN 1 ELSE 0 END AS INT) AS fy",
        "CAST(o_totalprice AS DECIMAL(14,2)) AS amt")

    def campaign_years() -> DataFrame:
        return lit_df([(y,) for y in CAMPAIGN_YEARS], "y int").selectExpr(
            "y", "CAST((y - 1) * 10000 + 701 AS INT) AS date_key_est")

    def calendar() -> DataFrame:
        days = tables.gift_base.selectExpr("date_key", "d AS calendar_date", "fy AS fiscal_year")
        starts = campaign_years().selectExpr("date_key_est AS date_key", "make_date(y - 1, 7, 1) AS calendar_date",
                                             "y AS fiscal_year")
        return days.unionByName(starts).distinct()

    t["adv_calendar_dv"] = calendar
    t["adv_campaign_d"] = lambda: campaign_years().selectExpr(
        "y", "date_key_est", "explode(array(1, 2)) AS k").selectExpr(
        "CAST(y * 10 + k AS INT) AS campaign_key", "CASE WHEN k = 1 THEN 'AF' ELSE 'CC' END AS campaign_type_sd",
        "date_key_est")
    t["adv_gift_description_d"] = lambda: lit_df(
        [(0, "N", "N"), (1, "N", "N"), (2, "N", "N"), (3, "N", "N"), (4, "N", "N"),
         (5, "Y", "N"), (6, "N", "Y")],
        "gift_description_key int, soft_credit_ind string, anon_ind string")
    t["adv_designation_d"] = lambda: lit_df(
        [(1, "Annual Fund"), (2, "Scholarship"), (3, "Library"), (4, "Athletics"), (5, "Unrestricted")],
        "designation_key int, designation_ld string")
    t["adv_hh_giving_f"] = lambda: tables.gift_base.selectExpr(
        "o_custkey - o_custkey % 2 AS household_key",
        "concat('G', CAST(o_orderkey - o_orderkey % 3 AS STRING)) AS gift_number",
        "date_key AS date_key_gift", "CAST(substring(o_orderpriority, 1, 1) AS INT) AS designation_key",
        CAMPAIGN_KEY.format(open="o_orderstatus = 'O'"),
        # households of every eleventh pair have soft credits only
        "CASE WHEN (o_custkey - o_custkey % 2) % 22 = 0 THEN 5 ELSE o_orderkey % 7 END AS gift_description_key",
        "CASE WHEN o_orderkey % 4 = 0 THEN CAST(NULL AS BIGINT) ELSE o_orderkey END AS pledge_number",
        "amt AS credit_amount")
    t["adv_credit_f"] = lambda: tables.gift_base.selectExpr(
        "o_custkey AS constituent_key_credit", "o_orderkey % 7 AS gift_description_key",
        CAMPAIGN_KEY.format(open="o_orderstatus = 'O'"), "fy AS fiscal_year", "amt AS credit_amount")
    t["adv_pldg_description_d"] = lambda: lit_df(
        [(0, "A", "N", "N"), (1, "P", "N", "N"), (2, "A", "Y", "N"), (3, "C", "N", "N"), (4, "A", "N", "Y")],
        "pldg_description_key int, pledge_status_sd string, soft_credit_ind string, anon_ind string")

    def pledge_install() -> DataFrame:
        li = raw("lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag", "l_extendedprice")
        gb = tables.gift_base.select("o_orderkey", "o_custkey", "fy")
        return li.join(gb, li.l_orderkey == gb.o_orderkey).selectExpr(
            "o_custkey AS constituent_key_pledger", "l_linenumber % 5 AS pledge_description_key",
            "CAST(fy * 10 + CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS INT) AS campaign_key",
            "fy AS install_fiscal_year",
            "CAST(l_extendedprice AS DECIMAL(14,2)) AS expected_amt",
            "CASE WHEN l_returnflag = 'N' THEN CAST(0 AS DECIMAL(14,2)) "
            "ELSE CAST(l_extendedprice AS DECIMAL(14,2)) END AS install_amt_paid")

    t["adv_pledge_install_f"] = pledge_install
    t["adv_donor_codes_d"] = lambda: lit_df(
        [(1, "A", "Alumni"), (2, "P", "Parent"), (3, "T", "Trustee"), (4, "TS", "Trustee Spouse"),
         (5, "F", "Friend"), (6, "S", "Student")],
        "donor_code_key int, donor_code_sd string, donor_code_ld string")

    def bridge(group_col: str, lo: int, hi: int, n_codes: int, keep: str, out_group: str, out_code: str):
        # distinct groups x every code key, through a generator (no cross join)
        groups = (tables.adv_constituent_d.where(f"{group_col} BETWEEN {lo} AND {hi}")
                  .selectExpr(f"{group_col} AS g").distinct())
        return (groups.selectExpr("g", f"explode(sequence(1, {n_codes})) AS code").where(keep)
                .selectExpr(f"g AS {out_group}", f"code AS {out_code}"))

    t["adv_donor_group_b"] = lambda: bridge(
        "donor_group_key", 0, 10, 6, "(g + code) % 5 = 0 OR (code IN (1, 2) AND g % 4 <> 3)",
        "donor_group_key", "donor_code_key")
    t["adv_exclusion_codes_d"] = lambda: lit_df(
        [(1, "DM", "No Mail"), (2, "DME", "No Email"), (3, "NS", "No Solicit"),
         (4, "NSE", "No Email Solicit"), (5, "NP", "No Phone Solicit"), (6, "NT", "No Text"),
         (7, "NO", "No Contact"), (8, "N25", "Not Solicitable"), (9, "VMS", "No Volunteer"),
         (10, "ZZ", "Other")],
        "exclusion_code_key int, exclusion_code_sd string, exclusion_code_ld string")
    t["adv_exclusion_group_b"] = lambda: bridge(
        "exclusion_group_key", 0, 29, 10, "(g * 3 + code) % 11 = 0 OR (g % 10 = 1 AND code IN (3, 4, 5))",
        "exclusion_group_key", "exclusion_code_key")

    def xref() -> DataFrame:
        con = tables.adv_constituent_d.select("constituent_key", "pidm", "primary_donor_code")
        q = con.selectExpr("constituent_key AS q_key", "pidm AS q_pidm")

        def hop(p: DataFrame, offset: int, code: str) -> DataFrame:
            return (p.join(q, q.q_key == p.constituent_key + offset)
                    .selectExpr("pidm AS aprxref_pidm", "q_pidm AS aprxref_xref_pidm",
                                f"{code} AS aprxref_xref_code"))

        students = con.where("primary_donor_code = 'S'")
        rel = ("CASE constituent_key % 6 WHEN 0 THEN 'SPS' WHEN 1 THEN 'CHL' WHEN 2 THEN 'SCH' "
               "WHEN 3 THEN 'WRD' WHEN 4 THEN 'PRT' ELSE 'SIB' END")
        return (hop(students, 1, "'PAR'")
                .unionByName(hop(con.where("constituent_key >= 0"), 7, rel))
                .unionByName(hop(students, 6, "'PAR'")))

    t["aprxref"] = xref
    t["aprpros"] = lambda: tables.adv_constituent_d.where("primary_donor_code = 'S'").selectExpr(
        "pidm AS aprpros_pidm", "'ADIN' AS aprpros_prtp_code",
        "CASE WHEN constituent_key % 2 = 0 THEN 'FAN' ELSE 'OTH' END AS aprpros_prcd_code")
    t["apracty"] = lambda: raw("events").selectExpr(
        "100000 + user_id AS apracty_pidm", "event_type AS apracty_actc_code").distinct()
    t["apracyr"] = lambda: raw("events").selectExpr(
        "100000 + user_id AS apracyr_pidm",
        # 'view' years are kept under a code that no activity has
        "CASE WHEN event_type = 'view' THEN 'view-none' ELSE event_type END AS apracyr_actc_code",
        "CAST(1990 + day(ts) AS STRING) AS apracyr_year").distinct()
    t["stvactc"] = lambda: lit_df(
        [("click", "Debate", "SOORG"), ("view", "Rowing", "SPRTS"), ("purchase", "Reunion", "ALUMN"),
         ("error", "Other", "MISC"), ("signup", "Council", "SOORG"), ("1276", "Dropped", "SOORG")],
        "stvactc_code string, stvactc_desc string, stvactc_actp_code string")
    t["stvactp"] = lambda: lit_df(
        [("SOORG", "Student Org"), ("SPRTS", "Club Sport"), ("ALUMN", "Alumni"), ("MISC", "Misc"),
         ("PARNT", "Parent"), ("ATHLE", "Athletics")],
        "stvactp_code string, stvactp_desc string")

    def degrees() -> DataFrame:
        alumni = tables.adv_constituent_d.where("primary_donor_code = 'A'")
        grad = "make_date(CAST(1930 + constituent_key % 70 AS INT), 5, 20) AS apradeg_date"
        first = alumni.where("constituent_key % 9 <> 0").selectExpr(
            "pidm AS apradeg_pidm", "1 AS apradeg_seq_no",
            "CASE WHEN constituent_key % 11 = 0 THEN '009999' ELSE '000100' END AS apradeg_sbgi_code",
            "CASE WHEN constituent_key % 15 = 0 THEN CAST(NULL AS STRING) ELSE 'BA' END AS apradeg_degc_code", grad)
        second = alumni.where("constituent_key % 10 = 0").selectExpr(
            "pidm AS apradeg_pidm", "2 AS apradeg_seq_no", "'000100' AS apradeg_sbgi_code",
            "'BS' AS apradeg_degc_code", grad)
        return first.unionByName(second)

    t["apradeg"] = degrees

    def majors() -> DataFrame:
        cust = raw("customer").select("c_custkey", "c_nationkey")
        head = ["100000 + c_custkey AS apramaj_pidm", "1 AS apramaj_adeg_seq_no"]
        return (cust.where("c_custkey % 4 <> 3")
                .selectExpr(*head, "CAST(c_nationkey AS STRING) AS apramaj_majr_code")
                .unionByName(cust.where("c_custkey % 2 = 0")
                             .selectExpr(*head, "CAST((c_nationkey + 3) % 30 AS STRING) AS apramaj_majr_code")))

    t["apramaj"] = majors
    t["stvmajr"] = lambda: raw("nation").selectExpr("CAST(n_nationkey AS STRING) AS stvmajr_code",
                                                    "n_name AS stvmajr_desc")
    t["afrctyp"] = lambda: raw("customer").where("c_custkey % 6 <> 0").selectExpr(
        "100000 + c_custkey AS afrctyp_constituent_pidm", "'2000' AS afrctyp_dcyr_code",
        "CAST((c_custkey % 9) * 1000 AS DECIMAL(14,2)) AS afrctyp_ask_amount",
        "CASE c_custkey % 8 WHEN 0 THEN 'TP' WHEN 1 THEN 'PA' WHEN 2 THEN 'MDS' WHEN 3 THEN 'MDSP' "
        "WHEN 4 THEN 'BFP' WHEN 5 THEN 'GG' WHEN 6 THEN 'PAR' ELSE 'XX' END AS afrctyp_sol_org")
    t["atvsicc"] = lambda: raw("region").selectExpr("CAST(r_regionkey AS STRING) AS atvsicc_code",
                                                    "r_name AS atvsicc_desc")
    t["aprehis"] = lambda: raw("customer").where("c_custkey % 4 = 1").selectExpr(
        "100000 + c_custkey AS aprehis_pidm",
        "CASE WHEN c_custkey % 12 = 1 THEN 'N' ELSE 'Y' END AS aprehis_primary_ind",
        "CASE WHEN c_custkey % 16 = 1 THEN make_date(1999, 1, 1) END AS aprehis_to_date",
        "CAST(c_custkey % 7 AS STRING) AS aprehis_sicc_code",
        "CASE WHEN c_custkey % 8 = 1 THEN 100000 + c_custkey - 1 END AS aprehis_empr_pidm",
        "'Engineer' AS aprehis_empl_position",
        "concat('Employer', CAST(c_custkey % 20 AS STRING)) AS aprehis_empr_name")

    def mail() -> DataFrame:
        cust = raw("customer").select("c_custkey")
        return (cust.where("c_custkey % 25 = 0")
                .selectExpr("100000 + c_custkey AS aprmail_pidm", "'SIO' AS aprmail_mail_code")
                .unionByName(cust.where("c_custkey % 50 = 0")
                             .selectExpr("100000 + c_custkey AS aprmail_pidm", "'SIB' AS aprmail_mail_code")))

    t["aprmail"] = mail
    t["adv_staff_d"] = lambda: raw("supplier").selectExpr(
        "s_suppkey AS staff_key", "s_suppkey AS constituent_key_staff",
        "CASE WHEN s_suppkey % 4 = 3 THEN 'N' ELSE 'Y' END AS wh_current_row")

    def assignments() -> DataFrame:
        # Every supplier of an order's lines is a staff member assigned to the
        # ordering customer: linear in the data.
        li = raw("lineitem").select("l_orderkey", "l_suppkey")
        od = raw("orders").select("o_orderkey", "o_custkey")
        return (li.join(od, li.l_orderkey == od.o_orderkey)
                .selectExpr("o_custkey AS constituent_key_prospect", "l_suppkey AS staff_key",
                            "'Y' AS wh_current_row",
                            "CASE WHEN o_custkey % 3 = 0 THEN 'STAF' ELSE 'VOL' END AS solicitor_code")
                .distinct())

    t["adv_assignments_f"] = assignments

    tables = Tables(t)
    return tables
