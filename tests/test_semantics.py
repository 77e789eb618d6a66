
from patronage.operators import population, rollups
from tests.test_blocks import FY, P, RV, SENTINEL, behavior, person


def test_status_spellings_differ_between_populations(make_tables):
    """1.5.2: the standard population accepts 'Partial_Pledger', the affiliation
    population 'Partial Pledger'."""
    people = [person(1, code="P"), person(2, code="P")]
    beh = [behavior(1, status="Partial_Pledger"), behavior(2, status="Partial Pledger")]
    t = make_tables(adv_constituent_d=people, adv_donor_behavior_ps=beh, adv_reportvars_d=RV)
    std = {r.constituent_key for r in population.population_standard(t, P).collect()}
    aff = {r.constituent_key for r in population.population_first_year(t, P).collect()}
    assert std == {1} and aff == {2}


def test_first_year_parent_qualifies_only_the_affiliation_population(make_tables):
    """A parent whose parent class year is FY+3, linked by a PAR edge to
    a student with the interest code, joins the affiliation population."""
    stu = person(5, code="S")
    par = person(6, code="P", parent_scy=str(FY + 3))
    t = make_tables(adv_constituent_d=[stu, par], adv_donor_behavior_ps=[behavior(6)],
                    aprpros=[(100005, "ADIN", "FAN")], aprxref=[(100005, 100006, "PAR")])
    assert [r.constituent_key for r in population.first_year_parents(t, P).collect()] == [6]
    assert [r.constituent_key for r in population.population_first_year(t, P).collect()] == [6]
    # FY+3 >= FY, so the numeric current-parent test admits them to the standard one too
    assert [r.constituent_key for r in population.population_standard(t, P).collect()] == [6]


def test_student_lists_skip_nulls_and_need_not_align(make_tables):
    """1.5.9: a student without activities still appears in names, not in activities."""
    kids = [person(10, code="S", gender="M", last=None), person(11, code="S", gender=None)]
    t = make_tables(
        adv_constituent_d=kids + [person(20, code="P")],
        aprxref=[(100010, 100020, "PAR"), (100011, 100020, "PAR")],
        apracty=[(100011, "click"), (100011, "signup")],
        stvactc=[("click", "Debate", "SOORG"), ("signup", "Council", "SOORG")],
        stvactp=[("SOORG", "Student Org")])
    (row,) = rollups.student_info(t).collect()
    assert row.par_pidm == 100020
    assert row.student_names == "Pref10 ; Pref11 Last"  # NULL last name concatenates as empty
    assert row.student_genders == "Male"                 # NULL gender skipped
    assert row.student_activities == "Debate, Council"    # one student's list, ordered by code


def test_not_equal_with_null_falls_through(make_tables):
    """``college_last_name <> last_name`` with a NULL side is unknown, so
    the former-name CASE yields NULL."""
    from patronage.plans import extracts
    people = [person(10, last=None, college="Maiden"), person(12, last="A", college="B"),
              person(14, last="C", college="C"), SENTINEL]
    t = make_tables(
        adv_reportvars_d=RV, adv_constituent_d=people,
        adv_contact_info_d=[(k,) + ("x",) * 12 for k in (10, 12, 14)],
        adv_donor_behavior_ps=[behavior(k) for k in (10, 12, 14)],
        adv_household_b=[(k, k, -1, "n/a") for k in (10, 12, 14)],
        adv_donor_codes_d=[(1, "A", "Alumni")], adv_donor_group_b=[(1, 1)])
    out = {r.Constituent_Externalid: r.Constituent_FormerName
           for r in extracts.constituent_extract(t, P).select("Constituent_Externalid",
                                                              "Constituent_FormerName").collect()}
    assert out == {"000000010": None, "000000012": "B", "000000014": None}


def test_every_query_runs_on_empty_tables(make_tables):
    """Only the parameter row exists: every file and block is empty, no errors."""
    from patronage.plans.registry import QUERIES
    t = make_tables(adv_reportvars_d=RV)
    for name, fn in QUERIES.items():
        assert fn(t, P).count() == 0, name
