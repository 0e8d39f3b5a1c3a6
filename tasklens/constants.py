"""Values that results depend on. Everything here is data, not logic."""

from __future__ import annotations

# --- Fixed values: results must agree on these exactly ----------------------

# Lifecycle event type -> canonical kind.
BROKER_KINDS = {
    "task-started": "started",
    "task-succeeded": "succeeded",
    "task-failed": "failed",
    "task-retried": "retried",
    "task-revoked": "revoked",
}

# Lifecycle signal -> canonical kind.
SIGNAL_KINDS = {
    "received": "received",
    "prerun": "started",
    "postrun": "succeeded",
    "failure": "failed",
    "retry": "retried",
    "revoked": "revoked",
}

KINDS = ("received", "started", "succeeded", "failed", "retried", "revoked")
TERMINAL_KINDS = ("succeeded", "failed", "revoked")
# Rows of this type tell a stream how far time has come; they are no events.
CLOCK_TYPE = "clock"
CLOCK = "clock"

# Stored result state -> canonical state.
CANONICAL_STATES = {
    "PENDING": "pending",
    "RECEIVED": "pending",
    "STARTED": "started",
    "SUCCESS": "success",
    "FAILURE": "failure",
    "RETRY": "pending",
    "REVOKED": "failure",
}
UNKNOWN_STATE = "unknown"

PRIORITIES = ("critical", "high", "normal", "low")
AMQP_PRIORITIES = {"critical": 9, "high": 6, "normal": 3, "low": 0}
REDIS_PRIORITIES = {"critical": 0, "high": 3, "normal": 6, "low": 9}
AMQP_DRIVERS = ("amqp", "pyamqp", "librabbitmq", "rabbitmq")

# Worker settings that may leave the worker.
WORKER_CONF_KEYS = (
    "task_serializer",
    "result_serializer",
    "accept_content",
    "task_default_queue",
    "worker_concurrency",
    "worker_prefetch_multiplier",
    "worker_max_tasks_per_child",
    "worker_max_memory_per_child",
    "task_acks_late",
    "task_reject_on_worker_lost",
    "task_time_limit",
    "task_soft_time_limit",
    "broker_pool_limit",
    "broker_heartbeat",
    "timezone",
    "enable_utc",
)
RECYCLE_LIMITS = ("worker_max_tasks_per_child", "worker_max_memory_per_child")

REDACTED = "[REDACTED]"
TRACEBACK_MARKER = "[... traceback truncated ...]\n"
EVENT_TRACEBACK_CHARS = 4096
RECONCILE_TRACEBACK_CHARS = 2000
EXCEPTION_SCAN_CHARS = 256
EXCEPTION_PATTERN = r"^([A-Za-z_]\w*(?:\.[A-Za-z_]\w*)*)\("
DEFAULT_EXCEPTION = "Exception"
DEFAULT_EXCEPTION_MESSAGE = "Unknown error"
SIGNATURE_CHARS = 2000
SHORT_ID_CHARS = 8
RATE_PATTERN = r"^(?:0|[1-9]\d*(?:/[smh])?)$"

INTERNAL_TASK_PREFIX = "celery."
DEFAULT_QUEUE = "celery"
DEFAULT_POOL = "prefork"
SOURCE_FILE_NAMES = ("tasks.py", "celery.py", "celery_tasks.py")
SOURCE_PACKAGE = "tasks"
SOURCE_FILE_BYTES = 2 * 1024 * 1024
TASK_DECORATORS = ("shared_task", "task")

EVENT_BUFFER_ROWS = 10_000
BULK_RETRY_DEFAULT = 1_000
BULK_RETRY_HARD_CAP = 10_000
CIRCUIT_BREAK_AFTER = 3
ETA_MAX_PAST_SECONDS = 60
ETA_MAX_FUTURE_SECONDS = 365 * 24 * 3600
ETA_MIN_EPOCH = -62_135_596_800
ETA_MAX_EPOCH = 253_402_300_799
PURGE_THRESHOLD = 1_000

# --- Our own choices ---------------------------------------------------------

ENGINE = "job-queue"

# A plain decimal or scientific number, as event producers write it.
NUMBER_PATTERN = r"^[ \t]*[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[ \t]*$"

# Default redaction: (name, pattern, replacement). The patterns use the common
# subset of the Java and RE2 dialects; groups are written ``$n``.
SENSITIVE_KEYS = (
    "password",
    "passwd",
    "secret",
    "token",
    "api_key",
    "apikey",
    "access_token",
    "refresh_token",
    "authorization",
    "private_key",
    "credit_card",
    "ssn",
)
TEXT_RULES = (
    (
        "assignment",
        # password, passwd, private_key, secret, ssn, token, api_key, apikey, authorization, credit_card; few branches, as
        # each of them is tried at every character. A quoted value runs to its closing quote or the end of its line. A bare one
        # ends with its word after a quoted key, as in JSON; after a plain key it may hold anything, so it runs to a quote or
        # the end of its line.
        r"(?i)(p(?:ass(?:word|wd)|rivate_key)|s(?:ecret|sn)|token|a(?:pi_?key|uthorization)|credit_card)"
        r"(?:([\"'][ \t]*[:=][ \t]*)(?:(\")[^\"\\\r\n]*(?:\\.[^\"\\\r\n]*)*|(')[^'\\\r\n]*(?:\\.[^'\\\r\n]*)*|[^ \t\r\n\"',;]+)"
        r"|([ \t]*[:=][ \t]*)(?:(\")[^\"\\\r\n]*(?:\\.[^\"\\\r\n]*)*|(')[^'\\\r\n]*(?:\\.[^'\\\r\n]*)*|[^\r\n\"']+))",
        "$1$2$3$4$5$6$7[REDACTED]",
    ),
    ("bearer", r"(?i)(bearer)[ \t]+[a-z0-9._~+/=-]+", "$1 [REDACTED]"),
    ("url_credentials", r"://[^/ \t\r\n:@]+:[^/ \t\r\n@]+@", "://[REDACTED]@"),
    ("cloud_key", r"AKIA[0-9A-Z]{16}", "[REDACTED]"),
)

# A text without any of these (lower-cased) cannot match the rule; looking for them is far cheaper than the pattern.
TEXT_STEMS = {"assignment": ("passw", "key", "secret", "token", "author", "credit_card", "ssn")}
