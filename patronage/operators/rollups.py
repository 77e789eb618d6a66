"""Per-person text roll-ups: exclusions, affiliations, student lists.

Exclusions and affiliations depend only on a person's *group* (bridge key), so
they are rolled up per group over the small bridge and code tables and then
looked up by each person through the group key; the person dimension is
never multiplied by codes and shuffled. This equals the per-person roll-up
because ``constituent_key`` is the person dimension's key. A group shared by a
third of all people is a many-to-one lookup: broadcast when the group table
is small, otherwise a sort-merge join whose skewed person side AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from patronage import constants as K
from patronage.operators.lists import ordered_lists
from patronage.functions import cat, decode, ordered_listagg
from patronage.params import Params
from patronage.tables import Tables


def exclusion_group_rollup(t: Tables) -> DataFrame:
    codes = (t.adv_exclusion_codes_d.where(F.col("exclusion_code_sd").isin(*K.EXCLUSION_CODES_LISTED))
             .select("exclusion_code_key", "exclusion_code_sd", "exclusion_code_ld"))
    rows = (t.adv_exclusion_group_b.select("exclusion_group_key", "exclusion_code_key")
            .join(codes, "exclusion_code_key")
            .withColumn("listed_ld", F.when(F.col("exclusion_code_sd") == K.EXCLUSION_HIDDEN_IN_TEXT,
                                            F.lit(None).cast("string"))
                        .otherwise(F.col("exclusion_code_ld"))))
    sd = F.col("exclusion_code_sd")
    return rows.groupBy("exclusion_group_key").agg(
        F.max(F.when(sd.isin(*K.EXCLUSION_NO_CONTACT), 1).otherwise(0)).alias("no_n25"),
        F.sum(F.when(sd.isin(*K.EXCLUSION_NO_SOLICIT), 1).otherwise(0)).alias("no_solc_parent"),
        ordered_listagg("listed_ld", ";", "exclusion_code_key", "listed_ld").alias("exclusion_string"))


def exclusion_rollup(t: Tables, p: Params | None = None) -> DataFrame:
    """Per person with any listed exclusion: no-contact flag, count of the
    three solicitation exclusions, and the exclusion text list."""
    return (t.adv_constituent_d.select("constituent_key", "exclusion_group_key")
            .join(exclusion_group_rollup(t), "exclusion_group_key")
            .select("constituent_key", "no_n25", "no_solc_parent", "exclusion_string"))


def affiliation_group_rollup(t: Tables) -> DataFrame:
    rows = (t.adv_donor_group_b.select("donor_group_key", "donor_code_key")
            .join(t.adv_donor_codes_d.select("donor_code_key", "donor_code_sd", "donor_code_ld"),
                  "donor_code_key"))
    return rows.groupBy("donor_group_key").agg(
        F.max(F.when(F.col("donor_code_sd").isin(*K.TRUSTEE_CODES), 1).otherwise(0)).alias("trustees"),
        ordered_listagg("donor_code_ld", ";", "donor_code_sd", "donor_code_ld").alias("affiliations"))


def affiliation_rollup(t: Tables, p: Params | None = None) -> DataFrame:
    """Per person with any donor code: trustee flag and affiliation list."""
    return (t.adv_constituent_d.select("constituent_key", "donor_group_key")
            .join(affiliation_group_rollup(t), "donor_group_key")
            .select("constituent_key", "trustees", "affiliations"))


def student_activities(t: Tables, p: Params | None = None) -> DataFrame:
    """Per student pidm, the club/sport/athletics activity names."""
    actc = t.stvactc.where(~F.col("stvactc_code").isin(*K.ACTIVITY_CODES_EXCLUDED))
    actp = t.stvactp.where(F.col("stvactp_code").isin(*K.STUDENT_ACTIVITY_TYPES)).select("stvactp_code")
    acts = (t.apracty.join(actc, F.col("apracty_actc_code") == F.col("stvactc_code"))
            .join(actp, F.col("stvactc_actp_code") == F.col("stvactp_code")))
    return (acts.groupBy(F.col("apracty_pidm").alias("pidm"))
            .agg(ordered_listagg("stvactc_desc", ", ", "stvactc_code", "stvactc_desc").alias("activities")))


def student_info(t: Tables, p: Params | None = None, parents: DataFrame | None = None) -> DataFrame:
    """Per parent pidm (of ``parents`` only, if given, so that a sentinel
    or NULL parent outside the population builds no list), the students' names, genders and activity lists,
    each ordered by student pidm (NULL entries skipped, so lists need not align).
    Every list takes its value as the second order key, so ties in the
    specified key (SURVEY 1.5.8) cannot reorder it between runs. A parent with
    very many students is gathered by ranges of student pidm."""
    students = (t.adv_constituent_d.where(F.col("primary_donor_code") == K.STUDENT)
                .select(F.col("pidm").alias("chl_pidm"), "pref_first_name", "last_name", "gender"))
    edges = (t.aprxref.where(F.col("aprxref_xref_code") == K.PARENT_EDGE)
             .select(F.col("aprxref_pidm").alias("chl_pidm"), F.col("aprxref_xref_pidm").alias("par_pidm")))
    if parents is not None:
        edges = edges.join(parents, "par_pidm", "left_semi")
    acts = student_activities(t).select(F.col("pidm").alias("chl_pidm"), "activities")
    rows = (edges.join(students, "chl_pidm").join(acts, "chl_pidm", "left")
            .select("par_pidm", "chl_pidm", "activities",
                    cat("pref_first_name", F.lit(" "), "last_name").alias("student_name"),
                    decode("gender", K.GENDER_LABELS, F.col("gender")).alias("student_gender")))
    return ordered_lists(rows, "par_pidm", "chl_pidm", {
        "student_names": ("student_name", "; "),
        "student_genders": ("student_gender", "; "),
        "student_activities": ("activities", "; ")})
