"""Labels, patterns, limits and column lists.

All of these must equal the values of the pipeline whose results are matched,
so they are stated once, here.
"""

from __future__ import annotations

# --- message kinds (fixed values) -----------------------------------------
MESSAGE_KINDS = ["user", "thinking", "tool_call", "tool_result"]

# --- rubric dimensions, scored 1..3 (fixed values) --------------------------
RUBRIC = [
    "question_understanding",
    "resource_exhaustion",
    "answer_grounding",
    "actionability",
]

# --- conversation types (fixed values) --------------------------------------
CLASSIFIABLE_TYPES = ["generation", "modification", "diagnostic", "consultation"]
EXCLUDED_TYPES = ["ghost", "anomalous", "unknown"]
SQL_TYPES = ["generation", "modification"]
CONSULTATION_TYPES = ["consultation"]
ANOMALOUS_ABOVE_TURNS = 75
ERA_CUT = "2026-03-01 00:00:00"

# --- outcome labels (fixed values) -------------------------------------------
SUCCESS_OUTCOMES = ["success_clean", "success_with_correction", "success_iterative"]
REVIEW_OUTCOMES = ["failure_wrong_direction"]
INCONCLUSIVE = "inconclusive"
TIERS = ["success", "failure", "inconclusive"]
GATE_DECISIONS = ["allow", "block_review", "block"]

# --- accepted values of the label seed (fixed values) -------------------------
SEED_OUTCOMES = [
    "success_clean",
    "success_with_correction",
    "failure_wrong_direction",
    "failure_knowledge_gap",
    "failure_abandoned",
    "inconclusive",
]
DIFFICULTIES = ["easy", "medium", "hard"]
DRIFT_BANDS = ["stable", "moderate", "significant", "unknown"]

# --- content patterns, case-insensitive LIKE (fixed values) -------------------
PREFETCH_CALL = "%schema_prefetch_tool%"
FILE_WRITE = "%Write(file_path=%"
SQL_FOLDER = "%/sql/%"
TODO_WRITE = "%TodoWrite%"
SQL_EXECUTION = ["%execute_sql%", "%OperationalError%", "%preview%"]
RESULT_PREVIEW = "%preview%"
DATABASE_ERROR = "%OperationalError%"
EXECUTOR_ERROR = "%execution_status: error%"
REVIEW_SCORE_LINE = "%Quality Score%"
REVIEW_SCORE_REGEX = "Quality Score[^0-9]*([0-9]+)"
CORRECTION_PHRASES = [
    "%should be%",
    "%should actually%",
    "%instead of%",
    "%wrong%",
    "%incorrect%",
    "%look in%",
    "%use%table%",
    "%not%right%",
]
STALE_DOCUMENT = "%Documentation sync last performed%"
TOOL_USE_ERROR = "%tool_use_error%"
CODEBASE_ERRORS = ["%ImportError%", "%ModuleNotFoundError%"]
REJECTED_TOOL = "%tool use was rejected%"

# --- transcript limits in characters (fixed values) ----------------------------
CONSULTATION_LIMITS = {"tool_result": 2000, "tool_call": 500, "user": 2000}
SQL_OUTPUT_LIMITS = {"tool_result": 2000, "tool_call": 500, "user": 4000}
CUT_SUFFIX = "... [truncated]"
TRANSCRIPT_CAP = 30000
TRANSCRIPT_HEAD = 20000
TRANSCRIPT_TAIL = 10000

# --- drift thresholds (fixed values) ----------------------------------------------
STABLE_BELOW = 0.10
MODERATE_BELOW = 0.25
GATE_DROP = -0.10

# --- reports (fixed values) --------------------------------------------------------
SPARSE_PERIOD_BELOW = 5
SPARSE_HISTORY_BELOW = 3
MONTHLY_UNDER_DAYS = 120
RECENT_WINDOW = 30
OUTLIER_SIGMAS = 2
TIME_AXES = ["created_at", "conversation_created_at", "classified_at"]
FALLBACK_AXIS = "classified_at"

# --- telemetry buckets (fixed values) ---------------------------------------------
LATENCY_BUCKETS = [1, 2, 5, 10, 20, 30, 60, 120]
SCORE_BUCKETS = [1, 1.5, 2, 2.5, 3]
INSERT_BUCKETS = [0.1, 0.5, 1, 2, 5, 10, 30]

# --- loading (fixed values) --------------------------------------------------------
FIRST_MARK = "2024-01-01 00:00:00"
JUDGE_ATTEMPTS = 3
JUDGE_PARALLELISM = 3
JUDGE_WAIT_SECONDS = 60
