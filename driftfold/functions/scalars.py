"""Native column functions: canonical encodings, hashes, URL and text normalisation, labels, due times.

All take and return Columns and stay inside the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftfold.schema import ERROR_LENGTH, HEALTHY, SHARD_SIZE, LinkPolicy, RetryPolicy, SchedulePolicy

KEEP_NULLS = {"ignoreNullFields": "false"}
#: How rows are written as JSON lines and read back: nulls kept, times as canonical UTC text.
WIRE = KEEP_NULLS | {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'"}


def epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def canonical_json(**fields: Column) -> Column:
    """Compact JSON of the fields in alphabetical order, nulls kept."""
    return F.to_json(F.struct(*[value.alias(name) for name, value in sorted(fields.items())]), KEEP_NULLS)


def fingerprint(**fields: Column) -> Column:
    return F.sha2(canonical_json(**fields), 256)


def profile_fingerprint(profile: Column, blog: Column, url: Column) -> Column:
    """Hash of what an observation claims, and of nothing else."""
    return fingerprint(profile_status=profile, blog_status=blog, blog_url=url)


def iso(ts: Column) -> Column:
    """Canonical UTC text of a timestamp, cut to the second."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_iso(text: Column) -> Column:
    """Timestamp of text that ends in Z, with or without a fraction; null for anything else."""
    ok = F.rlike(text, F.lit(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?Z$"))
    return F.when(ok, F.try_to_timestamp(F.regexp_replace(F.regexp_replace(text, "Z$", ""), "T", " ")).cast("timestamp_ntz"))


def change_value(kind: Column, status: Column, url: Column) -> Column:
    """A change event's value as JSON: a bare status for profiles, a status with its URL for blogs."""
    return F.when(kind == "profile_status", F.concat(F.lit('"'), status, F.lit('"'))).otherwise(canonical_json(status=status, url=url))


def event_id(user_id: Column, at: Column, kind: Column, old_json: Column, new_json: Column) -> Column:
    """First 24 hex digits of the hash of an event's canonical JSON; who ran it does not count."""
    text = F.concat(
        F.lit('{"changed_at":"'), iso(at), F.lit('","kind":"'), kind, F.lit('","new_value":'), new_json, F.lit(',"old_value":'), old_json, F.lit(',"user_id":'), user_id.cast("string"), F.lit("}")
    )
    return F.left(F.sha2(text, 256), F.lit(24))


def shard_start(user_id: Column, size: int = SHARD_SIZE) -> Column:
    return (F.floor(user_id / size) * size).cast("long")


def shard_name(user_id: Column, size: int = SHARD_SIZE) -> Column:
    """File name of an id's shard, first and last id padded to five digits or the last one's length."""
    start = shard_start(user_id, size)
    end = start + size - 1
    width = F.greatest(F.lit(5), F.length(end.cast("string")))
    return F.concat(F.lpad(start.cast("string"), width, F.lit("0")), F.lit("-"), F.lpad(end.cast("string"), width, F.lit("0")), F.lit(".jsonl"))


def sanitize_error(text: Column, length: int = ERROR_LENGTH) -> Column:
    """White space (Unicode's and U+001C to U+001F) collapsed, cut to length; null if nothing is left."""
    collapsed = F.trim(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " "))
    return F.left(F.nullif(collapsed, F.lit("")), F.lit(length))


_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"


def url_parts(url: Column) -> dict[str, Column]:
    """Scheme, authority, host, port, path, query and fragment by pattern: parse_url rejects hosts that are fine here."""
    url = F.regexp_replace(url, r"^\s+|\s+$", "")
    piece = {name: F.regexp_extract(url, _URL, n) for n, name in enumerate(("scheme", "authority", "path", "query", "fragment"), 1)}
    host = F.regexp_extract(piece["authority"], r"^(\[[^\]]*\]|[^:]*)(:([0-9]*))?$", 1)
    port = F.regexp_extract(piece["authority"], r"^(\[[^\]]*\]|[^:]*)(:([0-9]*))?$", 3)
    return piece | {"scheme": F.lower(piece["scheme"]), "host": F.regexp_replace(F.lower(host), r"\.+$", ""), "port": port}


def normalize_url(url: Column) -> Column:
    """Canonical http(s) URL for storage: lower-case scheme and host, no default port, path at least /; query and fragment kept.

    Null where the URL is no http(s) URL, has credentials, no host or an impossible port.
    """
    p = url_parts(url)
    port = F.when(p["port"] == "", F.lit(None)).otherwise(p["port"].try_cast("int"))
    default = F.when(p["scheme"] == "https", 443).otherwise(80)
    good = p["scheme"].isin("http", "https") & (p["host"] != "") & ~F.contains(p["authority"], F.lit("@")) & ((p["port"] == "") | port.between(0, 65535))
    shown = F.when(port.isNull() | (port == default), F.lit("")).otherwise(F.concat(F.lit(":"), port.cast("string")))
    path = F.when(p["path"] == "", F.lit("/")).otherwise(p["path"])
    return F.when(good, F.concat(p["scheme"], F.lit("://"), p["host"], shown, path, F.regexp_replace(p["query"], r"^\?$", ""), F.regexp_replace(p["fragment"], "^#$", "")))


def has_control(text: Column) -> Column:
    return F.rlike(text, F.lit(r"[\x00-\x1f\x7f]"))


def markdown_escape(text: Column) -> Column:
    """Backslashes and the characters that mean something in a table cell escaped; line breaks kept as <br>."""
    escaped = F.regexp_replace(text, r"([\\|\[\]*_`<>])", r"\\$1")
    return F.regexp_replace(F.regexp_replace(escaped, "\r", " "), "\n", "<br>")


def blog_label(url: Column) -> Column:
    """Authority and path without the trailing slashes."""
    p = url_parts(url)
    return F.concat(F.when(p["authority"] == "", url).otherwise(p["authority"]), F.regexp_replace(p["path"], "/+$", ""))


def short_date(text: Column) -> Column:
    """Date part of ISO text, the text itself if it is something else, a dash if there is none."""
    dated = F.rlike(text, F.lit("^.{4}-.{2}-.{2}"))
    return F.when(text.isNull() | (text == ""), F.lit("—")).when(dated, F.left(text, F.lit(10))).otherwise(text)


def health_status(status: Column, confirmed: Column) -> Column:
    """Health as shown: unchecked without a row, pending_failure while a failure is not confirmed."""
    known = F.coalesce(status, F.lit("unchecked"))
    return F.when(~known.isin(*HEALTHY, "unchecked") & (confirmed == F.lit(False)), F.lit("pending_failure")).otherwise(known)


# Labels of health statuses in the published table.
HEALTH_LABELS = {
    "reachable": "可访问",
    "redirected": "已重定向",
    "blocked": "拒绝自动检查",
    "timeout": "检查超时",
    "dns_error": "DNS 错误",
    "tls_error": "TLS 错误",
    "client_error": "HTTP 4xx",
    "server_error": "HTTP 5xx",
    "pending_failure": "待复核",
    "unchecked": "未检查",
}


def lookup(table: dict[str, str], key: Column, default: Column | None = None) -> Column:
    """Value of a small literal table; the key itself, or default, where it has none."""
    pairs = F.create_map(*[F.lit(x) for item in table.items() for x in item])
    return F.coalesce(F.try_element_at(pairs, key), key if default is None else default)


def health_label(status: Column) -> Column:
    return lookup(HEALTH_LABELS, status)


def confirmed(prefix: str = "") -> Column:
    return F.col(f"{prefix}last_confirmed_at").isNotNull()


def existing(prefix: str = "") -> Column:
    """Confirmed public or hidden."""
    return confirmed(prefix) & F.col(f"{prefix}profile_status").isin("public", "hidden")


def confirmed_missing(prefix: str = "") -> Column:
    return confirmed(prefix) & (F.col(f"{prefix}profile_status") == "missing")


def blog_present(prefix: str = "") -> Column:
    return (F.col(f"{prefix}profile_status") == "public") & (F.col(f"{prefix}blog_status") == "present") & F.col(f"{prefix}blog_url").isNotNull()


def listed_blog() -> Column:
    """The published list's own, looser test."""
    state = lambda c: F.lower(F.trim(F.col(c)))
    return (state("profile_status") == "public") & state("blog_status").isin("present", "confirmed") & (F.trim(F.coalesce("blog_url", F.lit(""))) != "")


def hours(n: Column | int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n) if isinstance(n, int) else n)


def days(n: int) -> Column:
    return F.make_dt_interval(F.lit(n))


def due_at(policy: SchedulePolicy = SchedulePolicy()) -> Column:
    """When a user record may be visited again; the epoch if it never was."""
    checked, first = F.col("last_checked_at"), F.coalesce("first_checked_at", epoch())
    # The exponent is clamped before the power: beyond two doublings the maximum holds anyway.
    retry = F.least(F.lit(policy.retry_base_hours) * F.pow(F.lit(2), F.least(F.greatest(F.col("consecutive_failures") - 1, F.lit(0)), F.lit(16))), F.lit(policy.retry_max_hours)).cast("int")
    interval = (
        F.when((F.col("profile_status") == "public") & (F.col("blog_status") == "present"), days(policy.blog_present_days))
        .when((F.col("profile_status") == "public") & (F.col("blog_status") == "absent"), days(policy.blog_absent_days))
        .when(F.col("profile_status") == "hidden", days(policy.hidden_days))
        .when(F.col("profile_status") == "missing", days(policy.missing_days))
        .otherwise(days(policy.unknown_days))
    )
    seen = F.coalesce("last_confirmed_at", checked)
    regular = seen + interval
    later = [F.when(F.col(c) > first, F.col(c)) for c in ("profile_changed_at", "blog_changed_at")]
    changed = F.greatest(*later)
    ordinary = F.when(changed.isNotNull() & (seen <= changed), F.least(regular, changed + days(policy.recent_change_days))).otherwise(regular)
    return (
        F.when(checked.isNull(), epoch())
        .when(F.col("pending_observation").isNotNull(), checked + hours(policy.pending_hours))
        .when(F.col("last_check_result") != "ok", checked + hours(retry))
        .otherwise(ordinary)
    )


def priority() -> Column:
    """Category of a due record, the most urgent first."""
    return (
        F.when(F.col("pending_observation").isNotNull(), 0)
        .when(F.col("last_check_result") != "ok", 1)
        .when(F.col("profile_status") == "unknown", 2)
        .when(F.col("blog_status") == "present", 3)
        .when(F.col("profile_status") == "public", 4)
        .when(F.col("profile_status") == "hidden", 5)
        .otherwise(6)
    )


def link_due_at() -> Column:
    """When a link may be checked again: 30 days after a healthy check, 24, 48 or 72 hours after failures, else at once."""
    failures = F.least(F.greatest(F.coalesce("consecutive_failures", F.lit(1)), F.lit(1)), F.lit(3)).cast("int")
    return (
        F.when(F.col("status").isNull() | F.col("checked_at").isNull(), epoch())
        .when(F.col("status").isin(*HEALTHY), F.col("checked_at") + days(30))
        .otherwise(F.col("checked_at") + hours(failures * 24))
    )


def retry_after_seconds(value: Column, now: Column, digits_only: bool = False) -> Column:
    """Seconds of a Retry-After header: a number, or an HTTP date against now; never negative."""
    text = F.trim(value)
    number = F.when(F.rlike(text, F.lit("^[0-9]+$" if digits_only else r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")), text.try_cast("double"))
    date = F.try_to_timestamp(F.regexp_extract(text, "^[A-Za-z]{3}, ([0-9]{2} [A-Za-z]{3} [0-9]{4} [0-9:]{8}) GMT$", 1), F.lit("dd MMM yyyy HH:mm:ss"))
    seconds = F.coalesce(number, (F.unix_timestamp(date) - F.unix_timestamp(now.cast("timestamp"))).cast("double"))
    return F.when(seconds.isNotNull(), F.greatest(F.lit(0.0), seconds))


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def pretty_json(row: Column) -> Column:
    """A struct as an indented JSON document with a final line break, its fields in the struct's order."""
    text = F.to_json(row, WIRE | {"pretty": "true"})
    # Only a line's own key stands before its first " : ", as keys hold no quotes and line breaks are escaped.
    return F.concat(F.regexp_replace(text, r'(?m)^( *"[^"]*") : ', "$1: "), F.lit("\n"))


def page_url(site: str, user_id: Column, token: Column | None = None) -> Column:
    """A user's page; with a token a query that no cache knows. Null for ids below 1."""
    plain = F.concat(F.lit(site), user_id.cast("string"))
    return F.when(user_id >= 1, plain if token is None else F.concat(plain, F.lit("?_icbi_fresh="), F.url_encode(token)))


def run_id(mode: str, at: Column, salt: Column) -> Column:
    """mode-stamp-hex8; the salt is whatever makes the run its own."""
    return F.concat_ws("-", F.lit(mode), F.date_format(at, "yyyyMMdd'T'HHmmss'Z'"), F.left(F.sha2(salt.cast("string"), 256), F.lit(8)))


def one_of(value: Column, allowed: tuple[str, ...], default: str | None = None) -> Column:
    """The value if it is in a closed set, read without regard to case and outer blanks, else the default."""
    tidy = F.lower(F.trim(value))
    return F.when(tidy.isin(*allowed), tidy).otherwise(F.lit(default).cast("string"))


def first_given(row: Column | str, *names: str) -> Column:
    """The first member of a JSON object that is there and not null, among alias names."""
    return F.coalesce(*[F.get_json_object(row, f"$['{name}']") for name in names])


def retry_wait(attempt: Column, retry_after: Column, jitter: Column, policy: RetryPolicy = RetryPolicy()) -> Column:
    """Seconds before the attempt after this one (from 1); null where there is none.

    The server's wish holds if it is short enough, and ends the attempts if not. Without one the wait doubles from
    the base up to the cap and moves by up to a fifth: jitter is between 0 and 1, a half leaves it as it is.
    """
    doubled = F.least(F.lit(policy.cap), F.lit(policy.base) * F.pow(F.lit(2.0), F.least(F.greatest(attempt - 1, F.lit(0)), F.lit(60))))
    moved = F.least(F.lit(policy.cap), doubled * (F.lit(0.8) + jitter * 0.4))
    wait = F.when(retry_after.isNull(), moved).when(retry_after <= policy.longest_retry_after, retry_after)
    return F.when(attempt < policy.attempts, wait)


def attempts_made(answers: Column, policy: LinkPolicy = LinkPolicy()) -> Column:
    """How many of a link's answers (retryable, retry_after), in order, are made: up to the first that ends the attempts."""
    ends = F.transform(answers, lambda a: ~F.coalesce(a["retryable"], F.lit(False)) | F.coalesce(a["retry_after"] > policy.longest_retry_after, F.lit(False)))
    first = F.array_position(ends, True)
    most = F.least(F.size(answers), F.lit(policy.retries + 1)).cast("long")
    return F.when(first > 0, F.least(first, most)).otherwise(most)
