"""Constraint checks: each finds its violations in one pass and gives rows (severity, code, message, path, user_id)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftfold.functions.scalars import normalize_url, profile_fingerprint, sanitize_error
from driftfold.operators.schedule import coverage_gaps
from driftfold.operators.views import summary
from driftfold.schema import BLOG_STATUSES, CHANGE_KINDS, CHECK_RESULTS, ERROR_LENGTH, HEALTHY, LINK_STATUSES, PERSONAL_FIELDS, PHASE_STATUSES, PROFILE_STATUSES, URL_LENGTH, USER_COLUMNS

ISSUE = "struct<severity:string,code:string,message:string>"
HEX64, VERSION = "^[0-9a-f]{64}$", r"^[A-Za-z0-9._+\-]{1,100}$"


def issue(when: Column, code: str, message: str, severity: str = "error") -> Column:
    return F.when(when, F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.lit(message).alias("message")))


def issues(df: DataFrame, checks: list[Column], path: Column, user_id: Column) -> DataFrame:
    """One row for each check that fires: a row of the table is read once, whatever the number of checks."""
    found = df.select(F.explode(F.array_compact(F.array(*checks))).alias("i"), path.alias("path"), user_id.cast("long").alias("user_id"))
    return found.select("i.severity", "i.code", "i.message", "path", "user_id")


def public_host(url: Column) -> Column:
    """Syntactic test of a canonical URL's host: not localhost, and no address outside the global ranges."""
    host = F.regexp_extract(url, r"^https?://(\[[^\]]*\]|[^:/?#]*)", 1)
    private = r"^(0|10|127)\.|^169\.254\.|^192\.168\.|^172\.(1[6-9]|2[0-9]|3[01])\.|^192\.0\.[02]\.|^198\.(1[89]|51\.100)\.|^203\.0\.113\.|^100\.(6[4-9]|[7-9][0-9]|1[01][0-9]|12[0-7])\.|^(22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
    numeric = F.rlike(host, F.lit(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"))
    v6 = F.rlike(host, F.lit(r"^\[(::|::1|f[cd].*|fe[89ab].*|ff.*|::ffff:.*)\]$"))
    return ~((host == "localhost") | F.endswith(host, F.lit(".localhost")) | (numeric & F.rlike(host, F.lit(private))) | v6)


def user_checks() -> list[Column]:
    """Row rules of a user record."""
    c = F.col
    p = c("pending_observation")
    profile, blog, url, raw = c("profile_status"), c("blog_status"), c("blog_url"), c("blog_url_raw")
    off = profile.isin("hidden", "missing", "unknown")
    seen = c("last_confirmed_at").isNotNull()
    claim = profile_fingerprint(profile, blog, url)
    own, pending_claim = c("source_fingerprint"), profile_fingerprint(p["profile_status"], p["blog_status"], p["blog_url"])
    ok = c("last_check_result") == "ok"
    return [
        issue(~F.endswith(c("profile_url"), F.concat(F.lit("/user/"), c("id").cast("string"))), "profile_url", "profile_url does not belong to the id"),
        issue((profile == "public") & (blog == "present") & url.isNull(), "missing_blog_url", "present blog requires blog_url"),
        issue((profile == "public") & (blog == "absent") & (url.isNotNull() | raw.isNotNull()), "absent_blog_url", "absent blog cannot retain a URL"),
        issue(off & (blog != "unknown"), "profile_blog_status", "profile must have unknown blog status"),
        issue(off & (url.isNotNull() | raw.isNotNull()), "profile_blog_url", "profile cannot expose a confirmed blog URL"),
        issue(url.isNotNull() & ~F.coalesce(public_host(normalize_url(url)), F.lit(False)), "blog_url", "blog_url must be a public HTTP(S) URL"),
        issue(F.length(url) > URL_LENGTH, "blog_url_length", "blog_url is too long"),
        issue(F.length(raw) > URL_LENGTH, "blog_url_length", "blog_url_raw is too long"),
        issue(ok & (c("consecutive_failures") != 0), "failure_count", "successful check must reset failures to zero"),
        issue(~ok & (c("consecutive_failures") < 1), "failure_count", "failed check must have a positive failure count"),
        issue(c("first_checked_at").isNull() | c("last_checked_at").isNull(), "attempt_timestamps", "every attempted id needs first and last check times"),
        issue(c("first_checked_at") > c("last_checked_at"), "timestamp_order", "first_checked_at is after last_checked_at"),
        issue(c("last_confirmed_at") > c("last_checked_at"), "timestamp_order", "last_confirmed_at is after last_checked_at"),
        issue(seen & own.isNull(), "fingerprint", "confirmed state requires source_fingerprint"),
        issue(seen & (own != claim), "fingerprint", "source_fingerprint does not match confirmed fields"),
        issue(~seen & (profile != "unknown"), "unconfirmed_state", "non-unknown state requires last_confirmed_at"),
        issue(~seen & (profile == "unknown") & p.isNull() & own.isNotNull(), "fingerprint", "unconfirmed record without a pending observation must have null fingerprint"),
        issue(~F.rlike(own, F.lit(HEX64)), "fingerprint", "source_fingerprint must be 64 lowercase hexadecimal characters"),
        issue(c("profile_changed_at") > c("last_confirmed_at"), "timestamp_order", "profile_changed_at is after last_confirmed_at"),
        issue(c("blog_changed_at") > c("last_confirmed_at"), "timestamp_order", "blog_changed_at is after last_confirmed_at"),
        issue(p["last_observed_at"] > c("last_checked_at"), "pending_timestamp", "pending observation is newer than last check"),
        issue(p["first_observed_at"] > p["last_observed_at"], "pending_timestamp", "pending first observation is after last observation"),
        issue(p.isNotNull() & (p["source_fingerprint"] != pending_claim), "pending_fingerprint", "pending fingerprint does not match candidate"),
        issue(~F.rlike(p["source_fingerprint"], F.lit(HEX64)), "pending_fingerprint", "pending fingerprint must be 64 lowercase hexadecimal characters"),
        issue(~F.rlike(p["parser_version"], F.lit(VERSION)), "parser_version", "pending parser_version is unsafe or too long"),
        issue(F.length(p["blog_url"]) > URL_LENGTH, "blog_url_length", "pending blog_url is too long"),
        issue(F.length(p["blog_url_raw"]) > URL_LENGTH, "blog_url_length", "pending blog_url_raw is too long"),
        issue((p["blog_status"] == "present") & p["blog_url"].isNull(), "pending_blog", "pending present blog requires a URL"),
        issue(~c("http_status").between(100, 599), "http_status", "HTTP status must be between 100 and 599"),
        issue(~F.rlike(c("parser_version"), F.lit(VERSION)), "parser_version", "parser_version is unsafe or too long"),
        issue(~(profile.isin(*PROFILE_STATUSES) & blog.isin(*BLOG_STATUSES) & c("last_check_result").isin(*CHECK_RESULTS)) | (c("id") < 1) | (c("consecutive_failures") < 0), "invalid_record", "a field is outside its closed set"),
    ]


def validate_users(users: DataFrame, path: str = "users") -> DataFrame:
    return issues(users, user_checks(), F.lit(path), F.col("id"))


def field_issues(rows: DataFrame, line: str = "line") -> DataFrame:
    """Field-set rules of raw JSON rows (path, line): missing, unknown and personal fields."""
    keys = F.json_object_keys(line)
    wanted = F.array(*[F.lit(c) for c in USER_COLUMNS])
    extra = F.array_except(keys, wanted)
    coded = F.transform(extra, lambda k: F.struct(F.lit("error").alias("severity"), F.when(F.lower(k).isin(*PERSONAL_FIELDS), "out_of_scope_personal_data").otherwise("unknown_field").alias("code"), F.concat(F.lit("field '"), k, F.lit("' is not part of the canonical schema")).alias("message")))
    lacking = F.array_sort(F.array_except(wanted, keys))
    missing = F.when(F.size(lacking) > 0, F.array(F.struct(F.lit("error").alias("severity"), F.lit("missing_fields").alias("code"), F.concat(F.lit("missing canonical fields: "), F.array_join(lacking, ", ")).alias("message")))).otherwise(F.array().cast(f"array<{ISSUE}>"))
    found = rows.where(keys.isNotNull()).select(F.explode(F.concat(missing, coded)).alias("i"), "path")
    return found.select("i.severity", "i.code", "i.message", "path", F.lit(None).cast("long").alias("user_id"))


def validate_coverage(users: DataFrame) -> DataFrame:
    gaps = coverage_gaps(users)
    return gaps.select(F.lit("error").alias("severity"), F.lit("record_coverage").alias("code"), F.concat(F.lit("missing user IDs: "), F.col("label")).alias("message"), F.lit("users").alias("path"), F.lit(None).cast("long").alias("user_id"))


#: Fields of the manifest that the records determine.
SUMMARY_FIELDS = ("blog_count", "highest_attempted_id", "highest_confirmed_user_id", "highest_existing_user_id", "n_hidden", "n_missing", "n_public", "n_unknown", "record_count")


def manifest_mismatches(users: DataFrame, manifest: DataFrame) -> DataFrame:
    """(field, expected, actual) of every manifest field that differs from the records'."""
    pair = manifest.select(*[F.col(f).cast("long").alias(f"a_{f}") for f in SUMMARY_FIELDS]).crossJoin(summary(users).select(*[F.col(f).alias(f"e_{f}") for f in SUMMARY_FIELDS]))
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"e_{f}").alias("expected"), F.col(f"a_{f}").alias("actual")) for f in SUMMARY_FIELDS])
    return pair.select(F.explode(rows).alias("r")).select("r.*").where("not (expected <=> actual)")


def validate_state(state: DataFrame, manifest: DataFrame, users: DataFrame) -> DataFrame:
    """Rules between the control row, the manifest row and the records' summary: three single rows side by side."""
    s = state.select(*[F.col(c).alias(f"s_{c}") for c in state.columns])
    m = manifest.select(*[F.col(c).alias(f"m_{c}") for c in manifest.columns])
    u = summary(users).select(*[F.col(c).alias(f"u_{c}") for c in ("record_count", "highest_attempted_id", "highest_existing_user_id")])
    c = F.col
    boundary = (c("s_phase") == "boundary_confirmation") | F.coalesce((c("s_phase") == "paused") & (c("s_paused_from_phase") == "boundary_confirmation"), F.lit(False))
    candidate, pending = c("s_boundary_candidate_start"), c("s_boundary_confirmation_pending")
    allowed = F.create_map(*[x for phase, statuses in PHASE_STATUSES.items() for x in (F.lit(phase), F.array(*map(F.lit, statuses)))])
    checks = [
        issue(c("s_highest_confirmed_user_id") > c("s_highest_attempted_id"), "state_frontier", "highest_confirmed_user_id cannot exceed highest_attempted_id"),
        issue(pending & candidate.isNull(), "state_boundary", "pending boundary confirmation requires boundary_candidate_start"),
        issue((c("s_phase") == "paused") & c("s_paused_from_phase").isNull(), "state_pause", "paused state requires paused_from_phase"),
        issue((c("s_phase") != "paused") & c("s_paused_from_phase").isNotNull(), "state_pause", "paused_from_phase must be null while running"),
        issue(c("s_next_id") <= c("s_highest_confirmed_user_id"), "state_next_id", "next_id is not beyond the confirmed frontier", "warning"),
        issue(boundary & (candidate.isNull() | ~pending), "state_boundary", "boundary confirmation requires a candidate and pending=true"),
        issue(~boundary & (candidate.isNotNull() | pending), "state_boundary", "non-boundary state cannot retain boundary fields"),
        issue(candidate < 1, "state_boundary_range", "boundary_candidate_start must be positive"),
        issue(candidate > c("s_highest_attempted_id"), "state_boundary_range", "boundary candidate cannot exceed the highest attempted id"),
        issue(c("s_highest_attempted_id") != c("u_highest_attempted_id"), "state_dataset_mismatch", "highest_attempted_id differs from the records"),
        issue(c("s_highest_confirmed_user_id") != c("u_highest_existing_user_id"), "state_dataset_mismatch", "highest_confirmed_user_id differs from the records"),
        issue(c("s_next_id") > c("u_highest_attempted_id") + 1, "state_next_id_gap", "next_id skips unrecorded ids"),
        issue(c("s_highest_attempted_id") != c("m_highest_attempted_id"), "state_manifest_mismatch", "state and manifest highest_attempted_id differ"),
        issue(c("s_highest_confirmed_user_id") != c("m_highest_confirmed_user_id"), "state_manifest_mismatch", "state and manifest highest_confirmed_user_id differ"),
        issue(c("s_phase") != c("m_phase"), "state_manifest_mismatch", "state and manifest phase differ"),
        issue(~F.coalesce(F.array_contains(F.try_element_at(allowed, c("s_phase")), c("m_initialization_status")), F.lit(False)), "state_manifest_status", "initialization_status is invalid for the phase"),
        issue((c("m_initialization_status") == "not_started") & ((c("s_highest_attempted_id") != 0) | (c("u_record_count") > 0)), "state_manifest_status", "not_started requires an empty dataset"),
    ]
    return issues(s.crossJoin(m).crossJoin(u), checks, F.lit("state"), F.lit(None))


def health_checks() -> list[Column]:
    """Row rules of link health."""
    c = F.col
    status, http, failures = c("status"), c("http_status"), c("consecutive_failures")
    healthy = status.isin(*HEALTHY)
    known = status.isin(*LINK_STATUSES)
    good = normalize_url(c("url")) == c("url")
    final = c("final_url")
    return [
        issue(~known, "health_status", "status is outside its closed set"),
        issue(~F.coalesce(good & public_host(c("url")), F.lit(False)), "health_url", "url must be a canonical public HTTP(S) URL"),
        issue(final.isNotNull() & ~F.coalesce(normalize_url(final) == final, F.lit(False)), "health_final_url", "final_url must be canonical"),
        issue(final.isNotNull() & (status != "blocked") & ~F.coalesce(public_host(final), F.lit(False)), "health_final_url", "final_url must be public unless blocked"),
        issue(~http.between(100, 599), "health_http_status", "http_status must be between 100 and 599"),
        issue(failures < 0, "health_failures", "consecutive_failures cannot be negative"),
        issue(c("attempts") < 1, "health_attempts", "attempts must be positive"),
        issue(c("redirect_count") < 0, "health_redirects", "redirect_count cannot be negative"),
        issue(F.length("error") > ERROR_LENGTH, "health_error", "error is too long"),
        issue(healthy & ((failures != 0) | c("failure_confirmed")), "health_healthy", "healthy record cannot retain failures"),
        issue(healthy & ~F.coalesce(http.between(200, 299), F.lit(False)), "health_healthy", "healthy record requires a 2xx status"),
        issue(healthy & (c("error").isNotNull() | final.isNull()), "health_healthy", "healthy record requires final_url and null error"),
        issue((status == "reachable") & (c("redirect_count") != 0), "health_redirects", "reachable status cannot contain redirects"),
        issue((status == "redirected") & (c("redirect_count") < 1), "health_redirects", "redirected status requires a redirect"),
        issue(known & ~healthy & (failures < 1), "health_failures", "unhealthy record requires a positive failure count"),
        issue(known & ~healthy & (failures >= 1) & (c("failure_confirmed") != (failures >= 2)), "health_confirmed", "failure confirmation does not match failure count"),
        issue(known & ~healthy & (F.trim(F.coalesce("error", F.lit(""))) == ""), "health_error", "unhealthy record requires an error"),
        issue(status.isin("timeout", "dns_error", "tls_error") & http.isNotNull(), "health_http_status", "status requires null http_status"),
        issue((status == "server_error") & ~F.coalesce(http.between(500, 599), F.lit(False)), "health_http_status", "server_error requires a 5xx status"),
        issue((status == "client_error") & (http.between(200, 299) | http.between(500, 599) | http.isin(403, 429)), "health_http_status", "client_error cannot contain this status"),
    ]


def validate_health(health: DataFrame) -> DataFrame:
    found = issues(health, health_checks(), F.col("url"), F.lit(None))
    return found.withColumnRenamed("path", "url").drop("user_id")


def validate_runs(runs: DataFrame) -> DataFrame:
    c = F.col
    checks = [
        issue(c("confirmed") > c("attempted"), "run_confirmed", "confirmed cannot exceed attempted"),
        issue(c("errors") > c("attempted"), "run_errors", "errors cannot exceed attempted"),
        issue(c("rate_limited") > c("errors"), "run_rate_limited", "rate_limited cannot exceed errors"),
        issue(c("finished_at") < c("started_at"), "run_times", "a run cannot finish before it starts"),
    ]
    return issues(runs, checks, c("run_id"), F.lit(None))


def _snapshot_faults(side: str, blog: Column) -> list[Column]:
    """Rules of one side of a blog event: exactly a status and a URL, and a URL just where there is a blog."""
    value = F.col(f"{side}_value")
    status, url = F.get_json_object(value, "$.status"), F.get_json_object(value, "$.url")
    shaped = F.coalesce(F.array_sort(F.json_object_keys(value)) == F.array(F.lit("status"), F.lit("url")), F.lit(False))
    return [
        issue(blog & ~shaped, "change_value", f"{side} value must hold a status and a URL"),
        issue(blog & shaped & ~F.coalesce(status.isin(*BLOG_STATUSES), F.lit(False)), "change_value", f"{side} status is outside its closed set"),
        issue(blog & shaped & ((status == "present") != url.isNotNull()), "change_value", f"{side} URL does not fit its status"),
    ]


def validate_changes(changes: DataFrame) -> DataFrame:
    """Values and legal transitions of change events. A profile event's value is a JSON text, a blog event's an object."""
    c = F.col
    kind = c("kind")
    profile, blog = kind == "profile_status", F.startswith(kind, F.lit("blog_"))
    old, new = F.get_json_object("old_value", "$.status"), F.get_json_object("new_value", "$.status")
    was, is_now = old == "present", new == "present"
    quoted = [f'"{s}"' for s in PROFILE_STATUSES]
    checks = [
        issue(~kind.isin(*CHANGE_KINDS), "change_kind", "kind is outside its closed set"),
        issue(c("user_id") < 1, "change_user", "a change belongs to a positive id"),
        issue(c("old_value") == c("new_value"), "change_same", "a change must change something"),
        issue(profile & ~F.coalesce(c("old_value").isin(*quoted) & c("new_value").isin(*quoted), F.lit(False)), "change_value", "profile values must be in their closed set"),
        *_snapshot_faults("old", blog),
        *_snapshot_faults("new", blog),
        issue((kind == "blog_added") & (was | ~is_now), "change_transition", "blog_added goes from no blog to a blog"),
        issue((kind == "blog_removed") & (~was | (new != "absent")), "change_transition", "blog_removed goes from a blog to none"),
        issue((kind == "blog_changed") & ((~was & is_now) | (was & (new == "absent"))), "change_transition", "blog_changed neither adds nor removes a blog"),
    ]
    if "run_id" in changes.columns:
        checks.append(issue(F.trim("run_id") == "", "change_run", "run_id must not be blank"))
    return issues(changes, checks, c("event_id"), c("user_id"))


def tidy_observations(rows: DataFrame) -> DataFrame:
    """Observations in the form in which they are kept: canonical URL, no blank raw URL, clean error text, own fingerprint."""
    claim = profile_fingerprint(F.col("profile_status"), F.col("blog_status"), F.col("blog_url"))
    ok = F.col("check_result") == "ok"
    tidy = rows.withColumns({"blog_url": normalize_url(F.col("blog_url")), "blog_url_raw": F.nullif(F.trim("blog_url_raw"), F.lit("")), "error": sanitize_error(F.col("error"))})
    return tidy.withColumn("source_fingerprint", F.when(ok, claim).otherwise(F.col("source_fingerprint")))


def validate_observations(rows: DataFrame) -> DataFrame:
    """What may be observed: closed sets for all, and for a successful check a claim that makes sense."""
    c = F.col
    profile, blog, url, raw, result = c("profile_status"), c("blog_status"), c("blog_url"), c("blog_url_raw"), c("check_result")
    ok, public = result == "ok", profile == "public"
    checks = [
        issue(~F.coalesce(c("user_id") >= 1, F.lit(False)), "observation_user", "user_id must be positive"),
        issue(~F.coalesce(profile.isin(*PROFILE_STATUSES) & blog.isin(*BLOG_STATUSES) & result.isin(*CHECK_RESULTS), F.lit(False)), "observation_value", "a field is outside its closed set"),
        issue(url.isNotNull() & normalize_url(url).isNull(), "observation_url", "blog_url must be an HTTP(S) URL"),
        issue(~F.coalesce(F.rlike(c("parser_version"), F.lit(VERSION)), F.lit(False)), "observation_version", "parser_version is unsafe or too long"),
        issue((F.length(url) > URL_LENGTH) | (F.length(raw) > URL_LENGTH), "observation_length", "a URL is too long"),
        issue(ok & public & (blog == "unknown"), "observation_claim", "a public profile shows whether it has a blog"),
        issue(ok & public & (blog == "present") & url.isNull(), "observation_claim", "a present blog has a URL"),
        issue(ok & public & (blog == "absent") & (url.isNotNull() | raw.isNotNull()), "observation_claim", "an absent blog has no URL"),
        issue(ok & profile.isin("hidden", "missing") & ((blog != "unknown") | url.isNotNull()), "observation_claim", "hidden and missing profiles show no blog"),
        issue(ok & (profile == "unknown"), "observation_claim", "a successful check knows the profile's status"),
    ]
    return issues(rows, checks, F.lit("observations"), c("user_id"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def report(found: DataFrame) -> DataFrame:
    """One row: errors, warnings, and whether the data are valid."""
    return found.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings")).withColumn("valid", F.col("errors") == 0)


