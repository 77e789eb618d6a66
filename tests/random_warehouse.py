"""Small random warehouses for differential tests.

Values are drawn from tiny domains so that NULLs, the 'n/a' sentinel,
duplicate rows, shared external ids, multi-person households, tied gift rows
and dangling keys all occur. Column order follows the test-data adapter's
schemas, so the same rows load into Spark and into DuckDB.
"""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

FY = 2000
DAYS = [dt.date(1999, 7, 1), dt.date(1999, 12, 1), dt.date(2000, 1, 5), dt.date(2000, 3, 9),
        dt.date(1996, 7, 1), dt.date(2000, 6, 30)]


def _key(d: dt.date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def _fy(d: dt.date) -> int:
    return d.year + (1 if d.month >= 7 else 0)


def warehouse(seed: int) -> dict[str, list[tuple]]:
    r = random.Random(seed)

    def pick(*xs):
        return r.choice(xs)

    def money(lo=0, hi=9000):
        return None if r.random() < 0.05 else Decimal(r.randint(lo * 100, hi * 100)) / 100

    people = list(range(1, 21))
    pidm = {k: 1000 + k for k in people}
    t: dict[str, list[tuple]] = {}
    t["adv_reportvars_d"] = [("VOLUNTR_FY", FY), ("OTHER_VAR", 1)]
    cons = []
    for k in people:
        cons_id = f"{k:09d}" if r.random() < 0.85 else f"{r.choice(people):09d}"  # some shared ids
        cons.append((k, pidm[k], cons_id, r.randint(1, 6), k, r.randint(0, 3), r.randint(0, 3),
                     pick("Mr.", None), pick("First", None), pick("M.", None), pick("L1", "L2", None),
                     pick("Jr.", None), pick("Pref", "P2", None), pick("L1", "L3", None),
                     pick("M", "F", "N", None), pick("single", None),
                     pick("1930", "1975", "1980", "1999", "2005", "2010", "n/a", None),
                     pick("1999", "2000", "2003", "2003", "n/a", "n/a", None), pick("A", "A", "P", "P", "S", "X"),
                     pick("Y", "N", "N", None), pick("Y", "N", None)))
    cons.append((-1, -1, "n/a", -1, -1, -1, -1) + (None,) * 9 + ("n/a", "n/a", "X", "N", "N"))
    t["adv_constituent_d"] = cons
    t["adv_household_b"] = [(hh, k, pick(-1, -1, r.choice(people), 99), pick("n/a", "Spouse", None))
                            for k, _, _, hh, *_ in cons if k > 0 for _ in range(pick(0, 1, 1, 1, 1, 2))]
    t["adv_contact_info_d"] = [(k,) + tuple(pick("n/a", "x n/a", "v", None) for _ in range(12)) for k in people]
    t["adv_donor_behavior_ps"] = [
        (k, fy, pick("Donor", "Pledger", "Partial_Pledger", "Partial Pledger", "Lybunt", "Sybunt2", "Never", "Never",
                     None),
         pick(0, 1, 3, None), pick(0, 2, None), pick(0, 1, None), pick(0, 4, None))
        for k in people for fy in (FY, FY, FY - 1) if r.random() < 0.6]
    t["adv_calendar_dv"] = [(_key(d), d, _fy(d)) for d in DAYS[:-1]]  # the last day is missing
    t["adv_campaign_d"] = [(1, "AF", _key(DAYS[0])), (2, "AF", _key(DAYS[4])), (3, "CC", _key(DAYS[0])),
                           (4, None, _key(DAYS[0])), (5, "AF", 19000101)]
    t["adv_gift_description_d"] = [(0, "N", "N"), (1, "N", "N"), (2, "Y", "N"), (3, "N", "Y"), (4, None, "N")]
    t["adv_designation_d"] = [(1, "Annual Fund"), (2, "Library"), (3, "Athletics")]
    days = [_key(d) for d in DAYS] + [None]
    t["adv_hh_giving_f"] = [
        (pick(1, 2, 3, 4, 5, 6, None), pick("G1", "G2", "G11", None), r.choice(days), pick(1, 2, 3, 4, None),
         pick(1, 1, 2, 3, 4, 5), pick(0, 0, 1, 2, 3, 4, 9), pick(1, 2, None), money()) for _ in range(r.randint(5, 50) if seed % 4 else 400)]  # every fourth seed: more than 99 rows a number
    t["adv_credit_f"] = [(r.choice(people + [None]), pick(0, 0, 1, 2, 3), pick(1, 1, 2, 3, 4, 5), pick(FY, FY - 1),
                          money()) for _ in range(r.randint(5, 40))]
    t["adv_pldg_description_d"] = [(0, "A", "N", "N"), (1, "P", "N", "N"), (2, "A", "Y", "N"),
                                   (3, "C", "N", "N"), (4, None, "N", "N")]
    t["adv_pledge_install_f"] = [(r.choice(people), pick(0, 0, 1, 2, 3, 4), pick(1, 1, 2, 3, 4), pick(FY, FY - 1),
                                  money(), money(0, 100)) for _ in range(r.randint(5, 40))]
    t["adv_donor_codes_d"] = [(1, "A", "Alumni"), (2, "P", "Parent"), (3, "T", "Trustee"),
                              (4, "TS", "Trustee Spouse"), (5, "F", "Friend")]
    t["adv_donor_group_b"] = [(r.randint(0, 3), r.randint(1, 6)) for _ in range(r.randint(4, 14))]
    t["adv_exclusion_codes_d"] = [(1, "DM", "No Mail"), (3, "NS", "No Solicit"), (4, "NSE", "No Email Solicit"),
                                  (5, "NP", "No Phone Solicit"), (7, "NO", "No Contact"),
                                  (8, "N25", "Not Solicitable"), (10, "ZZ", "Other"), (11, "MA", None)]
    t["adv_exclusion_group_b"] = [(r.randint(0, 3), pick(1, 3, 4, 5, 7, 8, 10, 11, 12))
                                  for _ in range(r.randint(0, 12))]
    codes = ["PAR", "PAR", "SPS", "CHL", "SCH", "WRD", "PRT", "SIB", None]
    students = [k for k, *rest in cons if k > 0 and rest[17] == "S"] or people
    parents = [k for k, *rest in cons if k > 0 and rest[17] == "P"] or people
    t["aprxref"] = ([(pidm[r.choice(people)], pick(pidm[r.choice(people)], 5555), r.choice(codes))
                     for _ in range(r.randint(0, 20))]
                    + [(pidm[r.choice(students)], pidm[r.choice(parents)], "PAR") for _ in range(r.randint(0, 8))])
    t["aprpros"] = [(pidm[r.choice(students)], pick("ADIN", "ADIN", "X"), pick("FAN", "FAN", "OTH"))
                    for _ in range(r.randint(0, 8))]
    t["apracty"] = [(pidm[r.choice(people)], pick("click", "signup", "view", "1276", "zzz"))
                    for _ in range(r.randint(0, 15))]
    t["apracyr"] = [(pidm[r.choice(people)], pick("click", "signup", "view"), pick("1995", "1996", None))
                    for _ in range(r.randint(0, 20))]
    t["stvactc"] = [("click", "Debate", "SOORG"), ("view", "Rowing", "SPRTS"), ("signup", "Council", "ATHLE"),
                    ("1276", "Dropped", "SOORG"), ("zzz", None, "PARNT")]
    t["stvactp"] = [("SOORG", "Student Org"), ("SPRTS", "Club Sport"), ("ATHLE", "Athletics"), ("PARNT", "Parent")]
    t["apradeg"] = [(pidm[r.choice(people)], pick(1, 2), pick("000100", "009999"), pick("BA", "BS", "MA", None),
                     pick(dt.date(1990, 5, 20), dt.date(1990, 12, 1), dt.date(2001, 5, 20), None))
                    for _ in range(r.randint(0, 12))]
    t["apramaj"] = [(pidm[r.choice(people)], pick(1, 2), pick("0", "1", "2", "99")) for _ in range(r.randint(0, 15))]
    t["stvmajr"] = [("0", "Arts"), ("1", "Biology"), ("2", None)]
    t["afrctyp"] = [(pidm[r.choice(people)], pick("2000", "1999", "x", None), money(0, 9000),
                     pick("TP", "PA", "MDS", "GG", "PAR", "XX", None)) for _ in range(r.randint(0, 12))]
    t["atvsicc"] = [("0", "Energy"), ("1", "Finance")]
    t["aprehis"] = [(pidm[r.choice(people)], pick("Y", "Y", "N", None), pick(None, None, dt.date(1999, 1, 1)),
                     pick("0", "1", "7"), pick(pidm[r.choice(people)], None), pick("Engineer", None),
                     pick("Acme", None)) for _ in range(r.randint(0, 10))]
    t["aprmail"] = [(pidm[r.choice(people)], pick("SIO", "SIB", "XX")) for _ in range(r.randint(0, 6))]
    t["adv_staff_d"] = [(1, 1, "Y"), (2, 2, "Y"), (3, 5, "Y"), (4, 77, "Y"), (5, 6, "Y"), (6, 5, "N")]
    t["adv_assignments_f"] = [(r.choice(people[:8]), pick(1, 1, 2, 2, 3, 4, 5, 6, 9), pick("Y", "Y", "N"),
                               pick("STAF", "STAF", "VOL")) for _ in range(r.randint(5, 25))]
    return t
