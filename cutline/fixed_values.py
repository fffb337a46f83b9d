"""Fixed values.

Everything here is a convention of the allotment lists (labels, codes, line patterns, thresholds,
column names). The values are stated as text because results are only right when they are equal.
"""

# --- rounds -----------------------------------------------------------------------------------
ROUND_LABELS = ("CAP-I", "CAP-II", "CAP-III", "CAP-IV")
UNREACHABLE_ROUND = "Unlikely"
ROUND_DISPLAY = {
    "CAP-I": "🟢 CAP-I",
    "CAP-II": "🟡 CAP-II",
    "CAP-III": "🟠 CAP-III",
    "CAP-IV": "🔴 CAP-IV",
    "Unlikely": "⚫ Unlikely",
}
DISPLAY_NAMES = {
    "institute_name": "College",
    "cap1_cutoff": "CAP-I Cutoff",
    "cap2_cutoff": "CAP-II Cutoff",
    "cap3_cutoff": "CAP-III Cutoff",
    "cap4_cutoff": "CAP-IV Cutoff",
    "likely_round": "Likely Round",
    "total_seats_filled": "Seats Filled",
}
DISPLAY_MISSING = "—"

# --- seat codes -------------------------------------------------------------------------------
PARSER_SEAT_CODES = (
    "GOPENS", "LOPENS", "GOBCS", "LOBCS", "GSCS", "LSCS", "GSTS", "LSTS",
    "GNT1S", "LNT1S", "GNT2S", "LNT2S", "GNT3S", "LNT3S", "GVJS", "LVJS",
    "GSEBCS", "LSEBCS", "GEWSS", "LEWSS",
    "PWDROPENS", "PWDROBCS", "PWDRSCS", "PWDRSTS", "PWDRSEBCS",
    "DEFROPENS", "DEFROBCS", "DEFRSCS", "DEFRSTS", "DEFRSEBCS",
    "DEFRNT3S", "DEFRNT2S", "DEFRNT1S",
    "DEFOBCS", "DEFOPENS", "PWDOBCS", "PWDOPENS",
    "DEFSCS", "DEFSEBCS", "PWDSCS", "PWDSEBCS",
    "DEFNT1S", "DEFNT2S", "DEFNT3S", "DEFVJS",
    "PWDNT1S", "PWDNT2S", "PWDNT3S", "PWDVJS",
    "ORPHAN", "TFWS", "EWS", "AI", "MI",
)
SEAT_MARKERS = ("^", "~", "*", "@", "&")
MARKER_CLASS = r"[~^*@&]"
OPEN_TO_ANY_GENDER = ("AI", "MI", "MI-MH", "EWS", "TFWS", "ORPHAN")

# Seat code at the end of a category text, with the three pool suffixes H, O and S.
SEAT_AT_END = (
    r"([GL](?:OPEN|OBC|SC|ST|SEBC|EWS|VJ|NT[123])[HOS]"
    r"|(?:PWD|DEF)R?(?:OPEN|OBC|SC|ST|SEBC|NT[123]|VJ)?[HOS]?"
    r"|MI-MH|MI|EWS|TFWS|ORPHAN|AI)\s*$"
)
MARKED_SEAT_AT_END = r"([~^*@&])\s+" + SEAT_AT_END
ANY_SEAT_AT_END = r"(?:([~^*@&])\s+)?" + SEAT_AT_END

# --- category clean-up ------------------------------------------------------------------------
CATEGORY_SUFFIXES = (r"/(?:DEF|PH)\d+", r"\s*\(NT-[ABCD]\)")
CATEGORY_SIGNS = "$#@"
CATEGORY_LEADING_WORDS = ("OPEN", "EWS", "SBC", "SEBC", "OBC", "SC", "ST")
CATEGORY_PATTERNS = (
    ("VJ/DT", r"(?i)^DT|^VJ"),
    ("NT1", r"(?i)NT\s*1|NT\s*A"),
    ("NT2", r"(?i)NT\s*2|NT\s*B|NT\s*C"),
    ("NT3", r"(?i)NT\s*3|NT\s*D"),
    ("PWD", r"(?i)PWD"),
    ("DEFENCE", r"(?i)DEF"),
)
CATEGORY_PATTERNS_V1 = (
    ("OPEN", r"(?i)OPEN"),
    ("EWS", r"(?i)EWS"),
    ("SBC", r"(?i)SBC|SEBC"),
    ("OBC", r"(?i)OBC"),
    ("SC", r"(?i)SC"),
    ("ST", r"(?i)ST"),
    ("VJ/DT", r"(?i)VJ|DT"),
    ("NT1", r"(?i)NT.?1|NT.?A"),
    ("NT2", r"(?i)NT.?2|NT.?B|NT.?C"),
    ("NT3", r"(?i)NT.?3|NT.?D"),
    ("PWD", r"(?i)PWD"),
    ("DEFENCE", r"(?i)DEF"),
)
CATEGORY_LEFTOVER_V1 = r"[$#@\(\)/0-9]"

# --- document lines ---------------------------------------------------------------------------
BOILERPLATE_STARTS = (
    r"Government of Maharashtra",
    r"State Common Entrance Test Cell",
    r"(P\s+)?Meri\s+Sr\.",
    r"No\.\s+No\.",
    r"State Level Seats",
    r"All India Seats",
    r"Seat Type\s*:",
    r"MI-Minority",
    r"PWDR\s*:",
    r"DEFR\s*:",
    r"Merit No\s*:",
    r"Page \d+ of \d+",
    r"Master of Engineering",
)
BOILERPLATE_PHRASES = (
    "Provisional Allotment List",
    "Degree Courses",
    "Integrated 5 Years",
    "Legends for SeatType",
    "Legends for ChoiceCode",
    "Red Color",
    "Black Color",
    "Green Color",
    "Blue Color",
    "Gray Color",
    "for the Year 20",
    "for the Admission",
)
APPLICATION_ID = r"EN\d{8}"
WHOLE_APPLICATION_ID = r"^EN\d{8}$"
INSTITUTE_LINE = r"^(\d{5})\s+(.+)$"
BRANCH_LINE = r"^(\d{10}(?:\[EWS\])?T?)\s*-\s*(.+)$"
BRANCH_CODE_LENGTH = 10
STATUS_LINE = r"^Status:\s*(.+?)(?:\s+Home University\s*:\s*(.+))?$"
SEAT_COUNTERS = (
    ("sanction_intake", r"Sanction Intake:\s*(\d+)"),
    ("cap_seats", r"CAP Seats:\s*(\d+)"),
    ("ms_seats", r"MS Seats:\s*(\d+)"),
    ("minority_seats", r"Minority Seats\s*:\s*(\d+)"),
    ("ai_seats", r"AI Seats:\s*(\d+)"),
)
VACANT = "VACANT"

# --- columns ----------------------------------------------------------------------------------
RAW_COLUMNS = (
    ("cap_round", "string"),
    ("institute_code", "string"),
    ("institute_name", "string"),
    ("branch_code", "string"),
    ("branch_name", "string"),
    ("is_ews", "boolean"),
    ("is_tfws", "boolean"),
    ("institute_status", "string"),
    ("home_university", "string"),
    ("sanction_intake", "int"),
    ("cap_seats", "int"),
    ("ms_seats", "int"),
    ("minority_seats", "int"),
    ("ai_seats", "int"),
    ("sr_no", "int"),
    ("merit_no", "int"),
    ("mhtcet_score", "double"),
    ("application_id", "string"),
    ("candidate_name", "string"),
    ("gender", "string"),
    ("candidate_category", "string"),
    ("seat_type", "string"),
    ("seat_marker", "string"),
    ("is_vacant", "boolean"),
    ("_validation_warnings", "string"),
)
PROTECTED_COLUMNS = ("candidate_name", "application_id", "gender")
MASK_TEXT = "***"
MAIN_MART_KEYS = (
    "institute_code", "institute_name", "branch_name", "clean_category", "seat_gender", "is_ews", "is_tfws",
)
POOL_MART_KEYS = (
    "institute_code", "institute_name", "branch_name", "clean_category", "seat_gender", "seat_pool",
)
V1_MART_KEYS = ("institute_code", "institute_name", "branch_name", "clean_category", "seat_gender")
# --- seats: (label, test, value), the first that holds. Suffixes come first on purpose: EWS and TFWS count as State, MI-MH as HomeUniv
SEAT_GENDERS = (
    ("F", "prefix", "L"),
    ("M", "prefix", "G"),
    ("ANY", "one_of", OPEN_TO_ANY_GENDER),
)
SEAT_GENDERS_V1 = (
    ("F", "prefix", "L"),
    ("M", "prefix", "G"),
    ("AI", "one_of", ("AI",)),
    ("MI", "one_of", ("MI",)),
)
SEAT_POOLS = (
    ("State", "suffix", "S"),
    ("HomeUniv", "suffix", "H"),
    ("Other", "suffix", "O"),
    ("AllIndia", "one_of", ("AI",)),
    ("Minority", "one_of", ("MI", "MI-MH")),
    ("TFWS", "one_of", ("TFWS",)),
    ("EWS", "one_of", ("EWS",)),
    ("Orphan", "one_of", ("ORPHAN",)),
    ("PWD", "prefix", "PWD"),
    ("Defence", "prefix", "DEF"),
)
POOLS_OUTSIDE_MAIN_MART = ("AllIndia", "Minority", "Orphan")

# --- quality rules: column -> (warn above %, fail above %, notes) -------------------------------
COMPLETENESS_RULES = {
    "mhtcet_score": (0.0, 1.0, ""),
    "seat_type": (5.0, 10.0, "known gap, baseline 4.16 %"),
    "seat_gender": (0.0, 1.0, ""),
    "seat_pool": (0.0, 1.0, ""),
    "clean_category": (0.0, 1.0, ""),
    "institute_name": (0.0, 1.0, ""),
    "branch_name": (2.0, 5.0, "known gap, baseline 1.42 %"),
    "cap_round_num": (0.0, 1.0, ""),
}
REPORT_COLUMNS_V1 = ("mhtcet_score", "gender", "seat_type", "clean_category", "institute_name", "branch_name")
RECONCILE_WARN_PCT, RECONCILE_FAIL_PCT = 16.0, 20.0
MART_GRAIN = ("institute_code", "branch_name", "clean_category", "seat_gender", "is_ews", "is_tfws")
CUTOFF_COLUMNS = ("cap1_cutoff", "cap2_cutoff", "cap3_cutoff", "cap4_cutoff")
BASELINE_ROWS, BASELINE_FILES = 735_136, 1_480
