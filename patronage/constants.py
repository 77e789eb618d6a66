"""Fixed values.

These codes and literals must equal the warehouse's own codes for the
extracts to select the same rows; they are stated here once, in the order the
extract specification lists them. Institution-specific labels and staff rules
are *not* here: they are parameters (``params.Params``).
"""

# --- fixed values -----------------------------------------------------------
FISCAL_YEAR_VAR = "VOLUNTR_FY"  # row of adv_reportvars_d holding the fiscal year

ALUMNI = "A"
PARENT = "P"
STUDENT = "S"

# og_donor_status values that qualify a parent (two spellings of the
# partial-pledger status occur; each extract keeps the one it was written with)
PARENT_STATUSES = ("Donor", "Pledger", "Partial_Pledger", "Lybunt", "Sybunt2")
PARENT_STATUSES_AFFILIATION = ("Donor", "Pledger", "Partial Pledger", "Lybunt", "Sybunt2")

ALUMNI_YEARS_BACK = 70           # alumni of the last 70 class years
FIRST_YEAR_PARENT_OFFSET = 3     # parent_scy of a first-year parent = FY + 3
PROSPECT_INTEREST_TYPE = "ADIN"
PROSPECT_INTEREST_CODE = "FAN"
PARENT_EDGE = "PAR"

ANNUAL_FUND = "AF"
NOT_FLAGGED = "N"                # soft_credit_ind / anon_ind value kept
PLEDGE_STATUSES_SUMMARY = ("A", "P")
PLEDGE_STATUS_ACTIVE = "A"
GIFT_YEARS_WINDOW = 4            # fiscal years FY-4 .. FY

# exclusions
EXCLUSION_CODES_LISTED = ("DM", "DME", "NS", "NSE", "NP", "NT", "NAS", "NBA", "NO",
                          "NPA", "NPM", "REF", "UNS", "N25", "VMS", "MA")
EXCLUSION_NO_CONTACT = ("NO", "N25", "VMS", "MA")
EXCLUSION_NO_SOLICIT = ("NS", "NSE", "NP")
EXCLUSION_HIDDEN_IN_TEXT = "N25"
EXCLUSION_ALL_SOLICIT_COUNT = 3

# affiliations
TRUSTEE_CODES = ("T", "TS")
AFFILIATION_FILE_CODES = ("A", "P")

# activities
ACTIVITY_TYPES = ("SOORG", "SPRTS", "ALUMN", "ATHLE", "PARNT")
STUDENT_ACTIVITY_TYPES = ("SOORG", "SPRTS", "ATHLE")
ACTIVITY_CODES_EXCLUDED = ("DTYP", "1276", "1259")

# degrees
DEGREE_CODES = ("BA", "BS")

# staff solicitation
SOLICITOR_STAFF = "STAF"
CURRENT_ROW = "Y"

# relatives: xref code -> relation label
RELATION_LABELS = (("SPS", "Spouse"), ("CHL", "Child"), ("SCH", "Stepchild"),
                   ("WRD", "Ward"), ("PRT", "Partner"))
GENDER_LABELS = (("M", "Male"), ("F", "Female"))

# selectability
TOP_PROSPECT_ORG = "TP"
NON_GRADUATE_AFTER_YEAR = "1975"
NO_RECENT_GIFT_YEARS = 5
PARENT_ASK_LIMIT = 5000
DECEASED = "Y"
MAIL_CODES = ("SIO", "SIB")

# sentinel text of the warehouse for "no value"
NOT_APPLICABLE = "n/a"
NONE_TOKEN = "none"

# gift summary row types
SUMMARY_PERSON_CREDIT = "Cash In - Summary"
SUMMARY_HOUSEHOLD_CASH = "Cash In"
GIFT_TYPE_CASH = "Cash In"
PLEDGE_MEASURES = ("Pledge Balance", "Pledge Amount",
                   "Pledge Balance - Summary", "Pledge Amount - Summary")
