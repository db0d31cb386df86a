"""Fixed values of the catalog domain, and names of tables, keys and computed columns.

The institution's own lists are defaults only: every operator takes them as arguments or DataFrames.
"""

from __future__ import annotations

# Subject and course codes that were renamed.
SUBJECT_CHANGES = {"G&G": "EPS", "STAT": "S&DS", "EENG": "ECE"}
CODE_CHANGES = {"ENGL 115": "ENGL 1015", "ENGL 121": "ENGL 1021", "CPSC 679": "CPSC 410", "CHNS 154": "CHNS 158", "CHNS 155": "CHNS 159", "LING 380": "LING 3800"}
# Titles too generic to link by instructor, and codes that only exact text may link.
GENERIC_TITLES = ["directed reading", "directed research", "reading and research", "tutorial", "senior essay", "senior project"]
EXACT_TEXT_CODES = ["HIST 164J", "HIST 447J"]
MAX_TEXT_DISTANCE = 0.25

# Abbreviations.
SKILLS = {"Writing": "WR", "Quantitative Reasoning": "QR", "Language (1)": "L1", "Language (2)": "L2", "Language (3)": "L3", "Language (4)": "L4", "Language (5)": "L5"}
AREAS = {"Humanities": "Hu", "Social Sciences": "So", ">Sciences": "Sc"}
STATUSES = {"A": "ACTIVE", "B": "MOVED_TO_SPRING_TERM", "C": "CANCELLED", "D": "MOVED_TO_FALL_TERM", "E": "CLOSED", "N": "NUMBER_CHANGED"}
COLLEGE_SEMINARS = ["CSBF", "CSBK", "CSBR", "CSDC", "CSES", "CSGH", "CSJE", "CSMC", "CSMY", "CSPC", "CSSM", "CSSY", "CSTC", "CSTD", "CSYC"]
CREDIT_SUFFIXES = [" credit for Yale College students", " credits for Yale College students"]
CREDIT_SUFFIX_LENGTH = 33

# Phrases that mark first-year and sophomore seminars.
FIRST_YEAR_PHRASES = [
    "Freshman Seminar Program", "First-Year Seminar Program", "Enrollment limited to freshmen", "Enrollment limited to first-years",
    "Enrollment limited to first-year students", "Intended for freshmen", "Intended for first-year students", "Priority to freshmen",
    "Priority to first-years", "preference to freshmen", "preference to first-years", "primarily for freshmen", "primarily for first-years",
]
SOPHOMORE_PHRASES = [
    "Enrollment limited to sophomores", "Sophomore Seminar", "Registration preference to sophomores", "Registration preference given to sophomores",
    "Registration preference is given to sophomores", "Enrollment limited to freshmen and sophomores", "Enrollment limited to first-years and sophomores",
    "Preference to sophomores", "Sophomore standing required", "Recommended for sophomores", "Intended for freshmen and sophomores",
    "Intended for first-year students and sophomores", "Priority to sophomores", "preference to freshmen and sophomores",
    "preference to first-years and sophomores", "primarily for freshmen and sophomores", "primarily for first-years and sophomores",
]
FIRST_YEAR_CODE = "DRST 0"

# Weekdays as bits, in week order.
DAYS = {"Su": 1, "M": 2, "T": 4, "W": 8, "Th": 16, "F": 32, "Sa": 64}
WEEKDAYS_MASK = 62

# Mojibake and its repair, in order.
MOJIBAKE = {
    "â€“": "–", "Â ": " ", "Ã§": "ç", "Ã¡": "á", "Ã©": "é", "Ã«": "ë",
    "Ã®": "î", "Ã¼": "ü", "Ã±": "ñ", "“": '"', "”": '"',
}

# The anonymity notice that questions may carry, and the codes that tags leave out.
NOTICE = "(Your anonymous response to this question may be viewed by Yale College students, faculty, and advisers to aid in course selection and evaluating teaching.)"
SIX_CATEGORY_QUESTION = "DR359"

# The default split specs, codes (or code and season) that stay apart although their texts link them.
SPLIT_SPECS: list[list[list[str | tuple[str, str]]]] = [
    [["ARBC 110", ("ARBC 501", "201403"), ("ARBC 500", "202303"), "ARBC 1100"], ["ARBC 120", "ARBC 1200"]],
    [["ARBC 130", ("ARBC 502", "202103"), "ARBC 1300"], ["ARBC 140", "ARBC 1400"]],
    [["ARBC 150", ("ARBC 504", "202103"), "ARBC 1500"], ["ARBC 151", "ARBC 1510"]],
    [["ARBC 136", "ARBC 156", "ARBC 1560", "ARBC 5110"], ["ARBC 146", "ARBC 166", "ARBC 1660", "ARBC 5120"]],
    [["ARBC 158"], ["ARBC 159"]],
    [["BENG 355L", "BENG 3100"], ["BENG 356L", "BENG 3110"]],
    [["CHNS 112", "CHNS 1120"], ["CHNS 122", ("CHNS 132", "201203"), ("CHNS 132", "201303"), ("CHNS 132", "201403"), ("CHNS 132", "201503"), ("CHNS 132", "201603"), ("CHNS 132", "201703"), "CHNS 1220"]],
    [["CHNS 132", "CHNS 1320"], ["CHNS 142", "CHNS 1420"]],
    [["CHNS 152", "CHNS 1520"], ["CHNS 153", "CHNS 1530"]],
    [["CHNS 154", "CHNS 158", "CHNS 1580"], ["CHNS 155", "CHNS 159", "CHNS 1590"]],
    [["CHNS 156", "CHNS 1560"], ["CHNS 157", "CHNS 1570"]],
    [["CHNS 170", "CHNS 1700", "CHNS 5700"], ["CHNS 171", "CHNS 1710", "CHNS 5710"]],
    [["PHYS 180", "PHYS 1800"], ["PHYS 181", "PHYS 1810"]],
    [["PHYS 401", "PHYS 4010"], ["PHYS 402", "PHYS 4020"]],
    [["PHIL 742", "PHIL 271", "LING 671", "LING 271", "LING 2710", "PHIL 2271", "LING 6710"], ["PHIL 703"]],
]

# Course codes in texts; wordings of one question, in order; codes that a tag's words do not apply to.
COURSE_CODES = r"[A-Z]+ \d+(?: \d+)?(?:/[A-Z]+ \d+(?: \d+)?)*"
QUESTION_MARKUP = [(r"[ \t\r\n]+", " "), (r"</?[a-z]+>", ""), (r" *(Comments|Ratings):$", "")]
QUESTION_WORDINGS = [("course or module", "course or workshop"), ("the professor?", "the professor(s)?"), ("professor's", "professor(s)'s"), ("YSE", "F&ES")]
QUESTION_NAMES = r"Behavioral & Inst Economics\s?"
QUESTION_ENDS = [(" for ?", "?"), (" in ?", "?")]
NO_FEEDBACK, RECOMMENDATIONS, NO_SKILLS = ["DR464"], ["DR113", "DR316"], ["SU122", "FS1003", "DR464"]

PRIMARY_KEYS = {
    "seasons": ["season_code"], "courses": ["course_id"], "listings": ["listing_id"], "course_professors": ["course_id", "professor_id"],
    "professors": ["professor_id"], "flags": ["flag_id"], "course_flags": ["course_id", "flag_id"], "buildings": ["code"],
    "locations": ["building_code", "room"], "evaluation_statistics": ["course_id"], "evaluation_questions": ["question_code"],
    "evaluation_narratives": ["id"], "evaluation_ratings": ["id"], "evaluation_narrative_summaries": ["course_id", "question_code"],
}
_HISTORY = ["same_course_id", "same_course_and_profs_id", "last_offered_course_id", "last_enrollment_course_id", "last_enrollment", "last_enrollment_season_code", "last_enrollment_same_professors"]
_AVERAGES = ["average_gut_rating", "average_professor_rating", "average_rating", "average_rating_n", "average_workload", "average_workload_n", "average_rating_same_professors", "average_rating_same_professors_n", "average_workload_same_professors", "average_workload_same_professors_n"]
COMPUTED_COLUMNS = {
    "seasons": ["term", "year"], "courses": _HISTORY + _AVERAGES, "professors": ["courses_taught", "average_rating", "average_rating_n"],
    "evaluation_statistics": ["avg_rating", "avg_workload"], "evaluation_questions": ["tag"], "evaluation_narratives": ["comment_neg", "comment_neu", "comment_pos", "comment_compound"],
}
SINK_COLUMNS = {
    "seasons": ["season_code", "term", "year"],
    "courses": ["course_id", "season_code", "primary_crn", "section", "title", "description", "requirements", "skills", "areas", "credits", "syllabus_url", "course_home_url", "regnotes", "extra_info", "rp_attr", "classnotes", "final_exam", "fysem", "sysem", "colsem", *_HISTORY, *_AVERAGES],
    "listings": ["listing_id", "course_id", "school", "subject", "number", "course_code", "section", "season_code", "crn"],
    "course_professors": ["course_id", "professor_id"],
    "professors": ["professor_id", "name", "email", "courses_taught", "average_rating", "average_rating_n"],
    "flags": ["flag_id", "flag_text"], "course_flags": ["course_id", "flag_id"],
    "course_meetings": ["course_id", "days_of_week", "start_time", "end_time", "location_id", "_building_code", "_room"],
    "buildings": ["code", "building_name", "url"], "locations": ["location_id", "building_code", "room"],
    "evaluation_statistics": ["course_id", "enrolled", "responses", "extras", "avg_rating", "avg_workload"],
    "evaluation_questions": ["question_code", "is_narrative", "question_text", "options", "tag"],
    "evaluation_narratives": ["id", "course_id", "question_code", "response_number", "comment", "comment_neg", "comment_neu", "comment_pos", "comment_compound"],
    "evaluation_ratings": ["id", "course_id", "question_code", "rating"],
    "evaluation_narrative_summaries": ["course_id", "question_code", "summary"],
}
FOREIGN_KEYS = [
    ("courses", "season_code", "seasons", "season_code"), ("listings", "course_id", "courses", "course_id"), ("listings", "season_code", "seasons", "season_code"),
    ("course_professors", "course_id", "courses", "course_id"), ("course_professors", "professor_id", "professors", "professor_id"),
    ("course_flags", "course_id", "courses", "course_id"), ("course_flags", "flag_id", "flags", "flag_id"), ("course_meetings", "course_id", "courses", "course_id"),
    ("locations", "building_code", "buildings", "code"), ("evaluation_statistics", "course_id", "courses", "course_id"),
    ("evaluation_narratives", "course_id", "courses", "course_id"), ("evaluation_narratives", "question_code", "evaluation_questions", "question_code"),
    ("evaluation_ratings", "course_id", "courses", "course_id"), ("evaluation_ratings", "question_code", "evaluation_questions", "question_code"),
]
#: Parents before children; deletes go the other way.
LOAD_ORDER = ["seasons", "courses", "listings", "professors", "course_professors", "flags", "course_flags", "buildings", "locations", "course_meetings", "evaluation_statistics", "evaluation_questions", "evaluation_narratives", "evaluation_ratings", "evaluation_narrative_summaries"]
#: Never deleted by an incremental sync.
KEPT_ON_DELETE = ["locations", "course_meetings", "courses"]
JUNCTIONS = {"course_professors": "course_id", "course_flags": "course_id"}
AUDIT_COLUMNS = ["time_added", "last_updated"]
