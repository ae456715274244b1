"""Fixed values of the student-records domain.

Everything in the FIXED VALUES block below must equal the values the
original pipeline uses, or cleaned tables, baskets, rules and advice stop
matching.  They are written out plainly, in their natural order.  Order is
significant where noted (dictionary priority, argmax tie-break).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original pipeline exactly)
# ---------------------------------------------------------------------------

# Course keys, in order.
COURSE_KEYS = ["math", "programming", "data_structures", "algorithms",
               "databases", "networks", "ai", "web"]

# Display labels of the grade columns, in course order.
COURSE_LABELS = {
    "math_grade": "Mathematics",
    "programming_grade": "Programming",
    "data_structures_grade": "Data Structures",
    "algorithms_grade": "Algorithms",
    "databases_grade": "Databases",
    "networks_grade": "Networks",
    "ai_grade": "Artificial Intelligence",
    "web_grade": "Web Development",
}

# Short item labels used in baskets and rules, in course order.
ITEM_LABELS = {
    "math_grade": "Math",
    "programming_grade": "Programming",
    "data_structures_grade": "DataStructures",
    "algorithms_grade": "Algorithms",
    "databases_grade": "Databases",
    "networks_grade": "Networks",
    "ai_grade": "AI",
    "web_grade": "Web",
}

# Canonical interest dictionary: (variant, canonical) in priority order.
# The prefix fallback takes the FIRST entry that matches, so order matters.
INTEREST_VARIANTS = [
    ("ai/ml", "AI/ML"),
    ("aiml", "AI/ML"),
    ("ai ml", "AI/ML"),
    ("a.i/ml", "AI/ML"),
    ("a.i. / ml", "AI/ML"),
    ("artificialintelligence/machinelearning", "AI/ML"),
    ("ai/machinelearning", "AI/ML"),
    ("web development", "Web Development"),
    ("web dev", "Web Development"),
    ("webdevelopment", "Web Development"),
    ("web developement", "Web Development"),
    ("web develoment", "Web Development"),
    ("web  development", "Web Development"),
    ("networks", "Networks"),
    ("network", "Networks"),
    ("neetworks", "Networks"),
    ("netwroks", "Networks"),
    ("netowrks", "Networks"),
    ("data science", "Data Science"),
    ("datascience", "Data Science"),
    ("dat science", "Data Science"),
    ("data sceince", "Data Science"),
    ("data  science", "Data Science"),
    ("software engineering", "Software Engineering"),
    ("softwareengineering", "Software Engineering"),
    ("softwre engineering", "Software Engineering"),
    ("sofware engineering", "Software Engineering"),
    ("software eng", "Software Engineering"),
    ("undecided", "Undecided"),
    ("undecideed", "Undecided"),
    ("un decided", "Undecided"),
    ("undecidied", "Undecided"),
]

# The only interest values allowed after cleaning.
VALID_INTERESTS = ["AI/ML", "Web Development", "Networks",
                   "Data Science", "Software Engineering", "Undecided"]

# Interest options accepted from a profile request, in form order.
INTEREST_OPTIONS = ["AI/ML", "Web Development", "Networks",
                    "Data Science", "Software Engineering", "Undecided"]

# Text that means "no value" (compared after strip + lower).
NONE_VARIANTS = ["none", "n/a", "na", "-", "", "null", "nan", "nil"]

# Whole-cell spellings turned into null right after loading.
LITERAL_NAN = ["nan", "NaN", "NAN"]

# Grade words and their numbers.
WORD_TO_NUMBER = {
    "zero": 0, "ten": 10, "twenty": 20, "thirty": 30, "forty": 40,
    "fifty": 50, "sixty": 60, "seventy": 70, "eighty": 80,
    "ninety": 90, "one hundred": 100, "hundred": 100,
}

# Unit suffix stripped once from the end of a grade.
GRADE_SUFFIX_PATTERN = r"\s*(pts?|points?|marks?|/100|%)\s*$"

# Track dimension, in dictionary order (first track wins score ties).
# core lists grade columns; electives and careers are display lists.
TRACKS = [
    {
        "track": "AI/Machine Learning",
        "short": "AI/ML",
        "interest": "AI/ML",
        "core": ["math_grade", "programming_grade", "data_structures_grade",
                 "algorithms_grade", "ai_grade"],
        "electives": ["Machine Learning", "Deep Learning", "Computer Vision",
                      "Natural Language Processing", "Reinforcement Learning"],
        "careers": ["Machine Learning Engineer", "AI Research Assistant",
                    "Computer Vision Engineer", "NLP Engineer"],
        "desc": "Best for students who enjoy intelligent systems, data-driven models, "
                "algorithms, and advanced AI applications.",
    },
    {
        "track": "Web Development",
        "short": "Web",
        "interest": "Web Development",
        "core": ["programming_grade", "data_structures_grade", "databases_grade",
                 "web_grade"],
        "electives": ["Advanced Front-End Development", "Back-End APIs",
                      "UI/UX Design", "Cloud Deployment", "Web Security"],
        "careers": ["Full-Stack Developer", "Front-End Engineer",
                    "Back-End Developer", "Web Application Developer"],
        "desc": "Best for students who want to build modern, usable, and scalable "
                "websites and web applications.",
    },
    {
        "track": "Network Engineering",
        "short": "Networks",
        "interest": "Networks",
        "core": ["programming_grade", "networks_grade", "math_grade"],
        "electives": ["Advanced Networking", "Cybersecurity", "Cloud Computing",
                      "Network Administration", "Ethical Hacking"],
        "careers": ["Network Engineer", "Security Analyst",
                    "Cloud Infrastructure Engineer", "Systems Administrator"],
        "desc": "Best for students who like infrastructure, communication systems, "
                "security, and cloud/network operations.",
    },
    {
        "track": "Data Science",
        "short": "Data",
        "interest": "Data Science",
        "core": ["math_grade", "programming_grade", "algorithms_grade",
                 "databases_grade", "ai_grade"],
        "electives": ["Statistics and Probability", "Data Mining",
                      "Big Data Analytics", "Data Visualization",
                      "Business Intelligence"],
        "careers": ["Data Scientist", "Data Analyst", "BI Developer",
                    "Analytics Engineer"],
        "desc": "Best for students who enjoy statistics, databases, patterns, "
                "dashboards, and decision-making from data.",
    },
    {
        "track": "Software Engineering",
        "short": "Software",
        "interest": "Software Engineering",
        "core": ["programming_grade", "data_structures_grade", "algorithms_grade",
                 "databases_grade", "web_grade"],
        "electives": ["Software Architecture", "Design Patterns",
                      "Agile Development", "DevOps and CI/CD",
                      "Software Testing and QA"],
        "careers": ["Software Engineer", "System Architect", "DevOps Engineer",
                    "QA Automation Engineer"],
        "desc": "Best for students who want to design reliable, maintainable "
                "software systems using engineering practices.",
    },
]

# Track score weights: core average, all-course average, gpa (x25),
# interest match bonus, undecided bonus, penalty per failed core course,
# penalty per weak core course.
SCORE_CORE_WEIGHT = 0.58
SCORE_ALL_WEIGHT = 0.17
SCORE_GPA_WEIGHT = 0.25
SCORE_GPA_SCALE = 25
SCORE_INTEREST_BONUS = 13
SCORE_UNDECIDED_BONUS = 1
SCORE_FAILED_CORE_PENALTY = 18
SCORE_WEAK_CORE_PENALTY = 4

# Grade thresholds.
PASS_MARK = 60          # >= passes
GOOD_MARK = 70          # >= good; < is weak
EXCELLENT_MARK = 85     # >= excellent
STRONG_CORE_MARK = 80   # >= strong core course in explanations

# Value ranges.
GPA_RANGE = (0.0, 4.0)
GRADE_RANGE = (0, 100)

# Profile request defaults.
FORM_GRADE_DEFAULT = 70
FORM_GPA_DEFAULT = 0.0
DEFAULT_ALGORITHM = "random_forest"

# Model keys and display labels.
ALGORITHM_LABELS = {
    "decision_tree": "Decision Tree",
    "random_forest": "Random Forest",
    "knn": "K-Nearest Neighbors",
}

# Model hyper-parameters.
DT_MAX_DEPTH = 12
DT_MIN_SAMPLES_SPLIT = 8
RF_TREES = 260
RF_MAX_DEPTH = 16
RF_MIN_SAMPLES_LEAF = 2
KNN_K = 9
SEED = 42
TEST_FRACTION = 0.2
CV_FOLDS = 5

# Rule mining parameters.
MIN_SUPPORT = 0.035
MIN_CONFIDENCE = 0.55
TOP_RULES = 80
DASHBOARD_RULES = 12
RULES_PER_PROFILE = 5
SIMILAR_STUDENTS = 4

# Feature-importance display groups.
IMPORTANCE_GROUPS = {
    "interest": "Student Interest",
    "flags": "Passed/Failed Courses",
    "gpa": "GPA",
    "excellent_count": "Excellent Course Count",
    "weak_count": "Weak Course Count",
}

# ---------------------------------------------------------------------------
# Derived names (computed from the fixed values above)
# ---------------------------------------------------------------------------

GRADE_COLS = [f"{k}_grade" for k in COURSE_KEYS]
PASSED_COLS = [f"{k}_passed" for k in COURSE_KEYS]
FAILED_COLS = [f"{k}_failed" for k in COURSE_KEYS]
COUNT_COLS = ["passed_count", "failed_count", "excellent_count", "weak_count"]

# Expected (whitelisted) columns, also the clean column order.
CLEAN_ORDER = (["student_id", "gpa"] + GRADE_COLS
               + ["interest", "passed_courses", "failed_courses"] + COUNT_COLS
               + PASSED_COLS + FAILED_COLS + ["recommended_track"])

# Raw column order: flags interleave per course, junk column at the end.
RAW_FLAG_COLS = [c for k in COURSE_KEYS for c in (f"{k}_passed", f"{k}_failed")]
RAW_ORDER = (["student_id", "gpa"] + GRADE_COLS
             + ["interest", "passed_courses", "failed_courses"] + COUNT_COLS
             + RAW_FLAG_COLS + ["recommended_track"])

BINARY_FEATURES = RAW_FLAG_COLS
NUMERIC_FEATURES = (["gpa"] + GRADE_COLS
                    + ["passed_count", "failed_count", "excellent_count", "weak_count"]
                    + BINARY_FEATURES)
CATEGORICAL_FEATURES = ["interest"]
FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES
TARGET = "recommended_track"

TRACK_NAMES = [t["track"] for t in TRACKS]
INTEREST_TO_TRACK = {t["interest"]: t["track"] for t in TRACKS}
TRACK_BY_NAME = {t["track"]: t for t in TRACKS}
INTEREST_MAP = dict(INTEREST_VARIANTS)
