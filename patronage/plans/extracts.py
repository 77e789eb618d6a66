"""The seven extract files (E1-E7) as DataFrames.

Each function takes the input tables and parameters and returns the file's
rows with its published column names. Three compute a part of their rows into
the shared checkpoint folder while the plan is built (the population of the
constituent and the gift summary file, the rows that the gift file numbers);
the others trigger no job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from patronage import constants as K
from patronage.functions import (cat, decode, mmddyyyy, ordered_listagg, sequence_suffix, strip_token,
                                 text_int, true_false, yyyy)
from patronage.operators import dims
from patronage.operators.giving import gift_summary, last_gift, non_annual_fund_gifts
from patronage.operators.population import (population_constituent, population_first_year,
                                            population_standard)
from patronage.operators.rollups import (affiliation_group_rollup, exclusion_group_rollup,
                                         student_info)
from patronage.operators.skew import numbered
from patronage.operators.solicitation import staff_solicited
from patronage.params import Params
from patronage.session import ensure_checkpoint_dir
from patronage.tables import Tables


def _standard(t: Tables, p: Params, pop: DataFrame | None) -> DataFrame:
    """The shared standard population, unless the caller already built it."""
    return population_standard(t, p) if pop is None else pop


# --------------------------------------------------------------------- E2
def activity_extract(t: Tables, p: Params, pop: DataFrame | None = None) -> DataFrame:
    """Person x activity x activity year for activity types of interest."""
    pop = _standard(t, p, pop).select("pidm", "cons_id")
    actc = t.stvactc.where(~F.col("stvactc_code").isin(*K.ACTIVITY_CODES_EXCLUDED))
    actp = t.stvactp.where(F.col("stvactp_code").isin(*K.ACTIVITY_TYPES))
    acts = (t.apracty.join(actc, F.col("apracty_actc_code") == F.col("stvactc_code"))
            .join(actp, F.col("stvactc_actp_code") == F.col("stvactp_code")))
    rows = pop.join(acts, F.col("pidm") == F.col("apracty_pidm"))
    # activity years are keyed by (person, activity, year): a left row meets
    # at most one row per distinct year, so no key of this join can be hot
    years = t.apracyr.select("apracyr_pidm", "apracyr_actc_code", "apracyr_year")
    rows = rows.join(years, (F.col("pidm") == F.col("apracyr_pidm"))
                     & (F.col("apracty_actc_code") == F.col("apracyr_actc_code")), "left")
    return rows.select(F.col("cons_id").alias("Constituent_Externalid"),
                       F.col("stvactc_desc").alias("Activity_Name"),
                       F.col("stvactp_desc").alias("Activity_Type"),
                       F.col("apracyr_year").alias("Activity_Year"))


# --------------------------------------------------------------------- E3
def affiliation_extract(t: Tables, p: Params) -> DataFrame:
    """Alumni / parent affiliation with the matching class year, sorted by id.
    (Unquoted aliases in the source dialect are upper-cased.)"""
    pop = population_first_year(t, p).select("cons_id", "donor_group_key", "scy", "parent_scy")
    codes = (t.adv_donor_codes_d.where(F.col("donor_code_sd").isin(*K.AFFILIATION_FILE_CODES))
             .select("donor_code_key", "donor_code_sd", "donor_code_ld"))
    bridge = t.adv_donor_group_b.select("donor_group_key", "donor_code_key").join(codes, "donor_code_key")
    sd = F.col("donor_code_sd")
    year = (F.when(sd == K.ALUMNI, strip_token("scy", K.NOT_APPLICABLE))
            .when(sd == K.PARENT, strip_token("parent_scy", K.NOT_APPLICABLE)))
    return (pop.join(bridge, "donor_group_key")
            .select(F.col("cons_id").alias("CONSTITUENT_ID"),
                    F.col("donor_code_ld").alias("AFFILIATION_NAME"),
                    year.alias("AFFILIATION_YEAR"))
            # the specified order is by id; the other columns only fix the
            # order of a person's rows so the file is the same on every run
            .orderBy(F.col("CONSTITUENT_ID").asc_nulls_last(), F.col("AFFILIATION_NAME").asc_nulls_last(),
                     F.col("AFFILIATION_YEAR").asc_nulls_last()))


# --------------------------------------------------------------------- E4
def degree_extract(t: Tables, p: Params, pop: DataFrame | None = None) -> DataFrame:
    """Own-school degrees with their majors joined by ';' in name order."""
    pop = _standard(t, p, pop).select("pidm", "cons_id")
    deg = (t.apradeg.where((F.col("apradeg_sbgi_code") == p.school_code)
                           & F.col("apradeg_degc_code").isNotNull())
           .select("apradeg_pidm", "apradeg_seq_no", "apradeg_degc_code", "apradeg_date"))
    maj = t.apramaj.select("apramaj_pidm", "apramaj_adeg_seq_no", "apramaj_majr_code")
    stv = t.stvmajr.select("stvmajr_code", "stvmajr_desc")
    rows = (pop.join(deg, F.col("pidm") == F.col("apradeg_pidm"))
            .join(maj, (F.col("apradeg_pidm") == F.col("apramaj_pidm"))
                  & (F.col("apradeg_seq_no") == F.col("apramaj_adeg_seq_no")), "left")
            .join(stv, F.col("apramaj_majr_code") == F.col("stvmajr_code"), "left"))
    return (rows.groupBy("cons_id", "apradeg_degc_code", "apradeg_date")
            .agg(ordered_listagg("stvmajr_desc", ";", "stvmajr_desc").alias("Constituent_DegreeMajor"))
            .select(F.col("cons_id").alias("Constituent_Externalid"),
                    F.col("apradeg_degc_code").alias("Constituent_Degree"),
                    yyyy("apradeg_date").alias("Constituent_DegreeYear"),
                    "Constituent_DegreeMajor"))


# --------------------------------------------------------------------- E5
GIFT_ORDER = ("constituent_key", "date_key_gift", "campaign_key", "designation_key",
              "gift_description_key", "pledge_number",
              # not in the published order; makes tied rows identical in every output column
              "credit_amount")


def gift_rows(t: Tables, p: Params, pop: DataFrame | None = None) -> DataFrame:
    """Population members x their household's countable annual-fund gifts of
    campaigns established in FY-4..FY (before numbering)."""
    lo, hi = dims.gift_window(p)
    gifts = (t.adv_hh_giving_f
             .join(dims.countable_gift_types(t), "gift_description_key")
             .join(t.adv_designation_d.select("designation_key", "designation_ld"), "designation_key")
             .join(dims.annual_fund_campaign_years(t, lo, hi), "campaign_key")
             .join(t.adv_calendar_dv.select(F.col("date_key").alias("date_key_gift"), "calendar_date"), "date_key_gift"))
    pop = _standard(t, p, pop).select("constituent_key", "household_key", "cons_id")
    return pop.join(gifts, "household_key")


def gift_extract(t: Tables, p: Params, pop: DataFrame | None = None) -> DataFrame:
    """Gift transactions; the id is the gift number (empty when NULL) plus the
    sequence within the gift number. The joined rows are computed once."""
    rows = numbered(gift_rows(t, p, pop), "gift_number", list(GIFT_ORDER), "seq")
    return rows.select(F.col("cons_id").alias("Constituent_Externalid"),
                       F.col("credit_amount").alias("Gift_Amount"),
                       F.lit(K.GIFT_TYPE_CASH).alias("Gift_Type"),
                       F.col("designation_ld").alias("Gift_Allocation"),
                       F.col("campaign_fy").alias("Gift_Year"),
                       cat("gift_number", sequence_suffix(F.col("seq").cast("int"))).alias("Gift_TransactionId"),
                       mmddyyyy("calendar_date").alias("Gift_Date"))


# --------------------------------------------------------------------- E6
def gift_summary_extract(t: Tables, p: Params, pop: DataFrame | None = None) -> DataFrame:
    """Person credit, household cash and pledge measures, stacked long. The
    population, which meets the facts by person and by household, is computed
    once, narrow, into the shared folder."""
    if pop is None:
        pop = population_standard(t, p).select("constituent_key", "household_key", "cons_id")
        ensure_checkpoint_dir(pop.sparkSession)
        pop = pop.checkpoint(eager=True)
    return gift_summary(t, p, pop)


# --------------------------------------------------------------------- E7
def relative_extract(t: Tables, p: Params, pop: DataFrame | None = None) -> DataFrame:
    """Spouses, children, stepchildren, wards and partners who have a class year."""
    pop = _standard(t, p, pop).select("pidm", "cons_id")
    edges = (t.aprxref.where(F.col("aprxref_xref_code").isin(*[c for c, _ in K.RELATION_LABELS]))
             .select("aprxref_pidm", "aprxref_xref_pidm", "aprxref_xref_code"))
    rel = (t.adv_constituent_d.where(F.col("scy") != K.NOT_APPLICABLE)
           .select(F.col("pidm").alias("rel_pidm"), F.col("cons_id").alias("rel_cons_id"),
                   "first_name", "last_name", "scy", "gender", "deceased_ind"))
    rows = (pop.join(edges, F.col("pidm") == F.col("aprxref_pidm"))
            .join(rel, F.col("aprxref_xref_pidm") == F.col("rel_pidm")))
    return rows.select(F.col("cons_id").alias("Constituent_Externalid"),
                       F.col("rel_cons_id").alias("Relative_ExternalId"),
                       cat("first_name", F.lit(" "), "last_name").alias("Relative_Name"),
                       F.col("scy").alias("Relative_ClassYear"),
                       decode("aprxref_xref_code", K.RELATION_LABELS).alias("Relative_Type"),
                       F.col("gender").alias("Relative_Gender"),
                       true_false(F.col("deceased_ind") == K.DECEASED).alias("Relative_Deceased"))


# --------------------------------------------------------------------- E1
NAME_COLUMNS = ("prefix", "first_name", "middle_name", "last_name", "suffix", "pref_first_name",
                "college_last_name", "gender", "marital_desc")
# Equal rows of one person are expanded in blocks of this many.
ASSIGNMENT_BLOCK = 1024
BEHAVIOR_COLUMNS = ("og_consec_yrs_giving", "lyr_og_consec_yrs_giving",
                    "bf_consec_yrs_giving", "lyr_bf_consec_yrs_giving")


def _prefixed(df: DataFrame, prefix: str, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in cols])


def _by_person(t: Tables, p: Params) -> DataFrame:
    """Per person with any: ``gives`` (a non-annual-fund gift) and ``ss_n``
    staff assignments. Both tests are stacked and aggregated once, so a person
    with a huge number of either is one row per task before the shuffle."""
    gifts = non_annual_fund_gifts(t, p).select(F.col("con_key").alias("side_key"), F.lit(1).alias("gift"))
    staff = staff_solicited(t, p).select(F.col("constituent_key").alias("side_key"), F.lit(1).alias("assignment"))
    return (gifts.unionByName(staff, allowMissingColumns=True).groupBy("side_key")
            .agg((F.count("gift") > 0).alias("gives"), F.count("assignment").alias("ss_n")))


def _by_pidm(t: Tables, p: Params, pidms: DataFrame) -> DataFrame:
    """Per pidm of ``pidms``, every combination of its different asks,
    employments, degrees and mail codes, with the number of rows it stands for
    (``side_n``, the product of the numbers of equal rows).

    The four tables are stacked, so they meet the people in one join. Equal
    rows are counted before anything is gathered (a pidm with a third of all
    mail rows is one row a task), and rows of sentinels and of people outside
    the population never reach a list."""
    asks = (t.afrctyp.where(text_int("afrctyp_dcyr_code") == F.lit(p.fiscal_year))
            .select(F.col("afrctyp_constituent_pidm").alias("side_pidm"), F.lit("ask").alias("kind"),
                    F.struct("afrctyp_ask_amount", "afrctyp_sol_org").alias("ask")))
    jobs = (t.aprehis.where((F.col("aprehis_primary_ind") == "Y") & F.col("aprehis_to_date").isNull())
            .select(F.col("aprehis_pidm").alias("side_pidm"), F.lit("job").alias("kind"),
                    F.struct("aprehis_sicc_code", "aprehis_empr_pidm", "aprehis_empl_position", "aprehis_empr_name").alias("job")))
    degrees = (t.apradeg.where((F.col("apradeg_sbgi_code") == p.school_code)
                               & F.col("apradeg_degc_code").isin(*K.DEGREE_CODES))
               .select(F.col("apradeg_pidm").alias("side_pidm"), F.lit("degree").alias("kind"),
                       F.struct("apradeg_degc_code").alias("degree")))
    mail = (t.aprmail.where(F.col("aprmail_mail_code").isin(*K.MAIL_CODES))
            .select(F.col("aprmail_pidm").alias("side_pidm"), F.lit("mail").alias("kind"),
                    F.struct("aprmail_mail_code").alias("mail")))
    stack = asks
    for side in (jobs, degrees, mail):
        stack = stack.unionByName(side, allowMissingColumns=True)
    kinds = ("ask", "job", "degree", "mail")
    counted = stack.groupBy("side_pidm", "kind", *kinds).agg(F.count(F.lit(1)).alias("m"))
    sides = (counted.join(pidms.toDF("side_pidm"), "side_pidm", "left_semi").groupBy("side_pidm")
             .agg(*[F.collect_list(F.when(F.col("kind") == k, F.struct(F.col(k), F.col("m")))).alias(k) for k in kinds]))
    for k in kinds:
        sides = sides.withColumn(k, F.explode_outer(k))
    times = F.lit(1)
    for k in kinds:
        times = times * F.coalesce(f"{k}.m", F.lit(1))
    return sides.select("side_pidm", *[f"{k}.{k}.*" for k in kinds], times.alias("side_n"))


def _repeated(df: DataFrame, times: Column) -> DataFrame:
    """Every row ``times`` (1 or more) times, in two steps so that no row
    carries an entry per copy."""
    zero, times = F.lit(0).cast("bigint"), times.cast("bigint")
    blocks = df.select("*", F.explode(F.sequence(zero, F.floor((times - 1) / ASSIGNMENT_BLOCK))).alias("__block"))
    last = F.least(times - 1 - F.col("__block") * ASSIGNMENT_BLOCK, F.lit(ASSIGNMENT_BLOCK - 1).cast("bigint"))
    return blocks.select("*", F.explode(F.sequence(zero, last)).alias("__copy"))


def constituent_extract(t: Tables, p: Params) -> DataFrame:
    """The 50-column constituent profile. Rows fan out exactly as the
    specification's joins do (two degrees, two mail codes, several staff
    assignments, ask or employment rows each give a row).

    Join order is chosen for the shuffles, not copied from the
    specification (inner joins commute with these left joins): the row stays
    in the order of its keys (person, household, spouse, pidm, employer), what
    is keyed by person and what is keyed by pidm is one stacked side table
    each, and the wide contact columns are attached last. Different asks,
    employments, degrees and mail codes of a person give a row where they are
    joined; equal ones and staff assignments are counted, and the row is
    repeated at the very end. The population is computed once into the shared folder; last gifts, student
    and side lists are built for its households, parents and people only.
    """
    fy = p.fiscal_year
    core = population_constituent(t, p, ("contact_info_key", "exclusion_group_key", "primary_donor_code",
                                         "deceased_ind", *NAME_COLUMNS), BEHAVIOR_COLUMNS)
    ensure_checkpoint_dir(core.sparkSession)
    core = core.checkpoint(eager=True)
    households = core.select("household_key").distinct()
    pidms = core.select("pidm").distinct()

    hhb = t.adv_household_b.select(F.col("household_key").alias("hh_key"), F.col("cons_key_sps1").alias("sps1_key"),
                                   "cons_key_sps2", "spouse_name")
    lg = _prefixed(last_gift(t, p, households), "lg_", ["household_key", "calendar_date", "designation_ld", "gift_amount"])
    spouse = _prefixed(t.adv_constituent_d, "sps_", ["constituent_key", "cons_id", "scy"])
    affil = affiliation_group_rollup(t)
    excl = exclusion_group_rollup(t)
    stu = student_info(t, p, pidms.toDF("par_pidm"))
    atv = t.atvsicc.select("atvsicc_code", "atvsicc_desc")
    emp = _prefixed(t.adv_constituent_d, "emp_", ["pidm", "last_name", "is_mg_company"])
    contact = t.adv_contact_info_d

    rows = (core
            .join(_by_person(t, p), F.col("constituent_key") == F.col("side_key"), "left")        # by person
            .join(hhb, (F.col("constituent_key") == F.col("sps1_key")) & (F.col("household_key") == F.col("hh_key")))
            .join(lg, F.col("household_key") == F.col("lg_household_key"), "left")                # by household
            .join(spouse, F.col("cons_key_sps2") == F.col("sps_constituent_key"))                 # by spouse
            .join(affil, "donor_group_key")                                                       # small group roll-ups
            .join(excl, "exclusion_group_key", "left")
            .join(_by_pidm(t, p, pidms), F.col("pidm") == F.col("side_pidm"), "left")             # by pidm
            .join(stu, F.col("pidm") == F.col("par_pidm"), "left")
            .join(atv, F.col("aprehis_sicc_code") == F.col("atvsicc_code"), "left")
            .join(emp, F.col("aprehis_empr_pidm") == F.col("emp_pidm"), "left")                   # by employer
            .join(contact, "contact_info_key"))                                                   # wide columns last
    assigned = F.coalesce("ss_n", F.lit(0))
    rows = _repeated(rows, F.greatest(assigned, F.lit(1)) * F.coalesce("side_n", F.lit(1)))

    c = F.col
    na = K.NOT_APPLICABLE
    masked = (c("trustees") == 1) | (c("afrctyp_sol_org") == K.TOP_PROSPECT_ORG)
    no_recent_gift = (F.coalesce(F.year("lg_calendar_date"), F.lit(0))
                      < F.lit(fy - K.NO_RECENT_GIFT_YEARS))
    # ordered rules, first match wins; an unknown condition falls through
    selectable = (
        F.when(c("trustees") == 1, "FALSE")                                    # trustee or trustee spouse
        .when(c("afrctyp_sol_org") == K.TOP_PROSPECT_ORG, "FALSE")             # top prospect
        .when(c("deceased_ind") == K.DECEASED, "FALSE")                        # deceased
        .when(c("no_n25") == 1, "FALSE")                                       # no contact / not solicitable
        .when(c("no_solc_parent") == K.EXCLUSION_ALL_SOLICIT_COUNT, "FALSE")   # all three solicit exclusions
        .when((c("primary_donor_code") == K.ALUMNI) & (c("scy") > K.NON_GRADUATE_AFTER_YEAR)
              & c("apradeg_degc_code").isNull() & no_recent_gift, "FALSE")     # recent non-graduate, no gift
        .when((c("primary_donor_code") == K.PARENT)
              & (c("afrctyp_ask_amount") >= K.PARENT_ASK_LIMIT), "FALSE")      # parent with a large ask
        .when(assigned > 0, "FALSE")                                          # has a staff solicitor
        .otherwise("TRUE"))
    segment = decode("afrctyp_sol_org", p.org_segment_labels)
    if p.class_segment:
        first, last, label = p.class_segment
        segment = F.when(c("scy").between(first, last), F.lit(label)).otherwise(segment)
    null_text = F.lit(None).cast("string")

    def streak(cur: str, last_year: str):
        return F.when(c(cur) == 0, c(last_year)).otherwise(c(cur))

    return rows.select(
        c("cons_id").alias("Constituent_Externalid"),
        c("prefix").alias("Constituent_Prefix"),
        c("first_name").alias("Constituent_FirstName"),
        c("middle_name").alias("Constituent_MiddleName"),
        c("last_name").alias("Constituent_LastName"),
        c("suffix").alias("Constituent_Suffix"),
        c("pref_first_name").alias("Preferred_FirstName"),
        F.when(c("college_last_name") != c("last_name"), c("college_last_name")).alias("Constituent_FormerName"),
        c("gender").alias("Constituent_Gender"),
        c("marital_desc").alias("Constituent_MaritalStatus"),
        strip_token("scy", na).alias("Constituent_PrefClassYear"),
        c("affiliations").alias("Constituent_Affiliation"),
        strip_token("pref_email", na).alias("Constituent_Email"),
        strip_token("home_phone", na).alias("Constituent_HomePhone"),
        strip_token("cell_primary", na).alias("Constituent_CellPhone"),
        strip_token("pref_mail_street1", na).alias("Constituent_AddressStreet1"),
        strip_token("pref_mail_street2", na).alias("Constituent_AddressStreet2"),
        strip_token("pref_mail_street3", na).alias("Constituent_AddressStreet3"),
        strip_token("pref_mail_city", na).alias("Constituent_AddressCity"),
        strip_token("pref_mail_state_code", na).alias("Constituent_AddressState"),
        strip_token("pref_mail_zip", na).alias("Constituent_AddressZip"),
        strip_token("pref_mail_nation_desc", na).alias("Constituent_AddressCountry"),
        F.when(masked, null_text).otherwise(mmddyyyy("lg_calendar_date")).alias("Constituent_LastGiftDate"),
        F.when(masked, null_text).otherwise(c("lg_designation_ld")).alias("LastGiftDesignation"),
        F.when(~F.coalesce(masked, F.lit(False)), c("lg_gift_amount")).alias("Constituent_LastGiftAmount"),
        streak("og_consec_yrs_giving", "lyr_og_consec_yrs_giving").alias("ConsecutiveGivingYears"),
        null_text.alias("Constituent_DonorStatus"),
        c("afrctyp_ask_amount").alias("Constituent_AskAmount"),
        selectable.alias("Constituent_Selectable"),
        F.lit("TRUE").alias("EditSelectableStatus"),
        null_text.alias("Constituent_TeamManager"),
        true_false(c("deceased_ind") == K.DECEASED).alias("Constituent_Deceased"),
        strip_token("exclusion_string", K.NONE_TOKEN).alias("Constituent_Restrictions"),
        segment.alias("Constituent_Segments"),
        strip_token("sps_cons_id", na).alias("Spouse_Externalid"),
        strip_token("spouse_name", na).alias("Spouse_Name"),
        strip_token("sps_scy", na).alias("Spouse_ClassYear"),
        c("aprehis_empl_position").alias("Business_JobTitle"),
        F.coalesce(c("emp_last_name"), c("aprehis_empr_name")).alias("Business_Employer"),
        c("atvsicc_desc").alias("Business_Industry"),
        true_false(c("emp_is_mg_company") == "Y").alias("Business_EmployerMatch"),
        strip_token("work_city", na).alias("Business_AddressCity"),
        strip_token("work_state_code", na).alias("Business_AddressState"),
        streak("bf_consec_yrs_giving", "lyr_bf_consec_yrs_giving").alias("ConsecGivingYearsBF"),
        strip_token("parent_scy", na).alias("Parent_ClassYear"),
        decode("aprmail_mail_code", p.mail_labels).alias("SchulerStatus"),
        true_false(c("gives")).alias("NonBFGiving"),
        c("student_names").alias("Student_Name"),
        c("student_genders").alias("Student_Gender"),
        c("student_activities").alias("Student_Activities"),
    )
