"""Table schemas, closed value sets and policy defaults."""

from __future__ import annotations

from dataclasses import dataclass

# The closed sets of the data model.
PROFILE_STATUSES = ("hidden", "missing", "public", "unknown")
BLOG_STATUSES = ("absent", "present", "unknown")
CHECK_RESULTS = ("ok", "rate_limited", "blocked_or_challenge", "server_error", "timeout", "network_error", "http_error", "parse_error", "suspected_stale")
CHANGE_KINDS = ("blog_added", "blog_changed", "blog_removed", "profile_status")
PHASES = ("bootstrap", "boundary_confirmation", "maintenance", "paused")
INIT_STATUSES = ("not_started", "in_progress", "complete", "paused")
LINK_STATUSES = ("reachable", "redirected", "blocked", "timeout", "dns_error", "tls_error", "client_error", "server_error")
HEALTHY = ("reachable", "redirected")
PARSE_FAILURES = ("parse_error", "suspected_stale")
TRANSIENT_FAILURES = ("http_error", "network_error", "server_error", "timeout")
RETRYABLE_STATUSES = (408, 425, 429, 500, 502, 503, 504)
REDIRECT_STATUSES = (301, 302, 303, 307, 308)
PERSONAL_FIELDS = ("avatar", "bio", "cookie", "description", "display_name", "email", "followers", "following", "name", "nickname", "raw_html", "reviews", "student_id", "username")
# Which initialisation statuses a phase allows.
PHASE_STATUSES = {"bootstrap": ("not_started", "in_progress"), "boundary_confirmation": ("in_progress",), "maintenance": ("complete",), "paused": ("paused",)}

PENDING = (
    "struct<blog_status:string,blog_url:string,blog_url_raw:string,confirmations:bigint,first_observed_at:timestamp_ntz,http_status:int,"
    "last_observed_at:timestamp_ntz,parser_version:string,profile_status:string,source_fingerprint:string>"
)
#: Columns of a user record in canonical (alphabetical) order.
USER_COLUMNS = {
    "blog_changed_at": "timestamp_ntz",
    "blog_status": "string",
    "blog_url": "string",
    "blog_url_raw": "string",
    "consecutive_failures": "bigint",
    "first_checked_at": "timestamp_ntz",
    "http_status": "int",
    "id": "bigint",
    "last_check_result": "string",
    "last_checked_at": "timestamp_ntz",
    "last_confirmed_at": "timestamp_ntz",
    "last_error": "string",
    "parser_version": "string",
    "pending_observation": PENDING,
    "profile_changed_at": "timestamp_ntz",
    "profile_status": "string",
    "profile_url": "string",
    "source_fingerprint": "string",
}
OBSERVATION_COLUMNS = {
    "blog_status": "string",
    "blog_url": "string",
    "blog_url_raw": "string",
    "check_result": "string",
    "error": "string",
    "http_status": "int",
    "observed_at": "timestamp_ntz",
    "parser_version": "string",
    "profile_status": "string",
    "source_fingerprint": "string",
    "user_id": "bigint",
}
#: The public summary and the control row, as one JSON object each; what a missing file stands for.
MANIFEST_COLUMNS = {
    "blog_count": "bigint",
    "generated_at": "timestamp_ntz",
    "highest_attempted_id": "bigint",
    "highest_confirmed_user_id": "bigint",
    "highest_existing_user_id": "bigint",
    "initialization_status": "string",
    "last_successful_run_at": "timestamp_ntz",
    "phase": "string",
    "profile_status_counts": "struct<hidden:bigint,missing:bigint,public:bigint,unknown:bigint>",
    "record_count": "bigint",
    "schema_version": "bigint",
    "updated_at": "timestamp_ntz",
}
STATE_COLUMNS = {
    "boundary_candidate_start": "bigint",
    "boundary_confirmation_pending": "boolean",
    "consecutive_missing_after_frontier": "bigint",
    "highest_attempted_id": "bigint",
    "highest_confirmed_user_id": "bigint",
    "last_run_id": "string",
    "maintenance_cursor": "bigint",
    "next_id": "bigint",
    "paused_from_phase": "string",
    "phase": "string",
    "schema_version": "bigint",
    "updated_at": "timestamp_ntz",
}
MANIFEST_DEFAULTS = {"initialization_status": "not_started", "phase": "bootstrap", "schema_version": 1}
STATE_DEFAULTS = {"boundary_confirmation_pending": False, "maintenance_cursor": 1, "next_id": 1, "phase": "bootstrap", "schema_version": 1}
HEALTH_COLUMNS = {
    "attempts": "bigint",
    "checked_at": "timestamp_ntz",
    "consecutive_failures": "bigint",
    "error": "string",
    "failure_confirmed": "boolean",
    "final_url": "string",
    "http_status": "int",
    "redirect_count": "bigint",
    "status": "string",
    "url": "string",
}
EVENT = "struct<at:timestamp_ntz,kind:string,old_status:string,old_url:string,new_status:string,new_url:string>"


@dataclass(frozen=True)
class SchedulePolicy:
    """Revisit intervals."""

    blog_present_days: int = 1
    blog_absent_days: int = 3
    hidden_days: int = 6
    missing_days: int = 6
    unknown_days: int = 1
    pending_hours: int = 24
    retry_base_hours: int = 24
    retry_max_hours: int = 72
    recent_change_days: int = 7


@dataclass(frozen=True)
class SafetyLimits:
    """Stop rules of a maintenance batch."""

    parse_failures: int = 5
    transient_failures: int = 10
    mass_attempts: int = 20
    mass_changes: int = 10
    mass_ratio: float = 0.25


@dataclass(frozen=True)
class RetryPolicy:
    """Waiting between attempts, in seconds."""

    attempts: int = 3
    base: float = 3.0
    cap: float = 60.0
    longest_retry_after: float = 120.0


@dataclass(frozen=True)
class LinkPolicy:
    """Attempts at a link, waits in seconds."""

    retries: int = 1
    base: float = 0.5
    longest_retry_after: float = 10.0


SHARD_SIZE = 1000
BOUNDARY_RUN = 256
CONFIRMATIONS = 2
URL_LENGTH = 2048
ERROR_LENGTH = 500


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())
