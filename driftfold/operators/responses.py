"""Decision tables over captured responses: page outcomes, staleness, robots, classification, links.

Sockets are out of scope: every function takes a table of what was captured and returns what is decided on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftfold.functions.scalars import any_of, fingerprint, lookup, profile_fingerprint
from driftfold.functions.web import EMPTY_FIELD, is_forbidden, may_read, read_page, resolve_chain, robots_delay
from driftfold.schema import REDIRECT_STATUSES, RETRYABLE_STATUSES

MOST_BYTES = 2_000_000
#: Characters of a body in which a challenge is looked for.
CHALLENGE_PREFIX = 250_000
# What gives a bot challenge away, in bodies, titles and response headers.
CHALLENGE_MARKS = ("cf-chl-", "challenge-platform")
CHALLENGE_TITLES = ("just a moment...", "checking your browser")
CHALLENGE_WORDS = ("turnstile", "captcha", "challenge")
HUMAN_TEXT = "verify you are human"
HTML_TYPES = ("text/html", "application/xhtml+xml")
KEPT_HEADERS = ("age", "cache-control", "cf-cache-status", "content-type", "date", "etag", "expires", "last-modified", "retry-after", "via", "warning", "x-cache")
# Check results of outcomes other than ok; all others are http_error.
OUTCOME_RESULTS = {
    "rate_limited": "rate_limited",
    "blocked_or_challenge": "blocked_or_challenge",
    "robots_disallowed": "blocked_or_challenge",
    "robots_unavailable": "network_error",
    "server_error": "server_error",
    "timeout": "timeout",
    "network_error": "network_error",
}
PARSER_VERSION = "1.0.0"


def _has_any(text: Column, words: tuple[str, ...]) -> Column:
    return any_of([F.contains(text, F.lit(w)) for w in words])


def is_challenge(body: Column) -> Column:
    low = F.lower(F.left(F.coalesce(body, F.lit("")), F.lit(CHALLENGE_PREFIX)))
    titles = tuple(f"<title>{t}</title>" for t in CHALLENGE_TITLES)
    return _has_any(low, CHALLENGE_MARKS) | _has_any(low, titles) | (F.contains(low, F.lit(HUMAN_TEXT)) & _has_any(low, CHALLENGE_WORDS))


def page_outcome() -> Column:
    """Outcome of a captured page request (robots_allowed, robots_status, exact_allowed, exception, http_status, body, body_bytes, content_type)."""
    status = F.col("http_status")
    return (
        F.when(~F.col("robots_allowed") & F.col("robots_status").isin(200, 401, 403), "robots_disallowed")
        .when(~F.col("robots_allowed"), "robots_unavailable")
        .when(~F.col("exact_allowed"), "robots_disallowed")
        .when(F.col("exception") == "timeout", "timeout")
        .when(F.col("exception").isNotNull(), "network_error")
        .when(F.col("body_bytes") > MOST_BYTES, "response_too_large")
        .when(status.between(300, 399), "redirect_rejected")
        .when(status.isin(401, 403) | is_challenge(F.col("body")), "blocked_or_challenge")
        .when(status == 429, "rate_limited")
        .when(status.isin(408, 425), "http_error")
        .when(status >= 500, "server_error")
        .when(status != 200, "http_error")
        .when((F.col("content_type") != "") & ~_has_any(F.lower("content_type"), HTML_TYPES), "invalid_content_type")
        .otherwise("ok")
    )


def retryable(status: Column) -> Column:
    return status.isin(*RETRYABLE_STATUSES)


def last_attempts(attempts: DataFrame, key: str = "user_id", most: int = 3) -> DataFrame:
    """The attempt that counts of each request: the first that cannot be retried, or the last one allowed."""
    final = ~retryable(F.col("http_status")) | (F.col("attempt") >= most)
    stop = attempts.groupBy(key).agg(F.coalesce(F.min(F.when(final, F.col("attempt"))), F.max("attempt")).alias("attempt"))
    return attempts.join(stop, [key, "attempt"])


def kept_headers(headers: Column) -> Column:
    return F.map_filter(headers, lambda k, v: k.isin(*KEPT_HEADERS))


def stale_reasons(cf: Column, age: Column, x_cache: Column, warning: Column) -> Column:
    """Why a response may be an old copy, as an array."""
    cf, shown, seconds = F.upper(cf), F.upper(x_cache), F.greatest(F.trim(age).try_cast("int"), F.lit(0))
    return F.array_compact(
        F.array(
            F.when(cf.isin("HIT", "STALE", "UPDATING"), F.concat(F.lit("CF-Cache-Status="), cf)),
            F.when(seconds.isNotNull() & (seconds > 0), F.concat(F.lit("Age="), seconds.cast("string"))),
            F.when(F.contains(shown, F.lit("HIT")) | F.contains(shown, F.lit("STALE")), F.concat(F.lit("X-Cache="), x_cache)),
            F.when(F.rlike(warning, F.lit(r"(?:^|\s)11[01](?:\s|$)")), F.concat(F.lit("Warning="), warning)),
        )
    )


def chosen_response(first: DataFrame, refetched: DataFrame, key: str = "user_id") -> DataFrame:
    """Of a stale response and its cache-busted refetch the refetch alone; fresh ones stay."""
    stale = first.where("suspected_stale")
    again = refetched.join(stale.select(key), key, "left_semi")
    return first.join(again.select(key), key, "left_anti").unionByName(again.select(*first.columns))


def robots_verdict() -> Column:
    """Whether a captured robots answer (http_status, body, exact_allowed) lets pages be read; refusal unless it says so."""
    status = F.col("http_status")
    return F.when(status == 200, ~is_challenge(F.col("body")) & F.col("exact_allowed")).when(status.isin(404, 410), True).otherwise(False)


def with_robots(requests: DataFrame, robots: DataFrame, agent: str) -> DataFrame:
    """requests with exact_allowed: the one captured robots text against each exact URL, query included."""
    rules = robots.select(F.col("body").alias("rules"), F.col("http_status").alias("robots_status")).limit(1)
    joined = requests.crossJoin(F.broadcast(rules))
    allowed = F.when(F.col("robots_status").isin(404, 410), True).otherwise(may_read(F.col("rules"), F.lit(agent), F.col("requested_url")))
    return joined.withColumn("exact_allowed", allowed).drop("rules")


def robots_outcomes(answers: DataFrame, agent: str) -> DataFrame:
    """answers (body, http_status, exact_allowed) with allowed and crawl_delay: what one robots file asks of the agent.

    Only a file that was read can ask for a delay.
    """
    read = (F.col("http_status") == 200) & ~is_challenge(F.col("body"))
    delay = robots_delay(F.when(read, F.col("body")), F.lit(agent))
    return answers.withColumn("allowed", F.coalesce(robots_verdict(), F.lit(False))).withColumn("crawl_delay", F.when(read & ~F.isnan(delay), delay))


def field_meaning(f: Column) -> Column:
    """(status, raw, url) of one labelled field's facts."""
    told, given = F.nullif(f["rest"], F.lit("")), F.nullif(f["raw"], F.lit(""))
    status = (
        F.when(f["target"].isNotNull() | f["plain"].isNotNull(), "present")
        .when((f["links"] == 0) & (f["rest"] == EMPTY_FIELD), "absent")
        .otherwise("unknown")
    )
    raw = F.when(status == "absent", F.lit(None)).otherwise(F.coalesce(given, told))
    return F.struct(status.alias("status"), raw.alias("raw"), F.coalesce(f["target"], f["plain"]).alias("url"))


def classify_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """pages with profile_status, blog_status, blog_url, blog_url_raw, check_result, error and source_fingerprint.

    The parser gives facts; the order in which they count is this expression.
    """
    facts = pages.withColumn("f", read_page(F.col(body)))
    f = F.col("f")
    low, text = F.lower(F.coalesce(F.col(body), F.lit(""))), F.lower(f["text"])
    challenge = _has_any(low, CHALLENGE_MARKS) | f["title"].isin(*CHALLENGE_TITLES) | (F.contains(text, F.lit(HUMAN_TEXT)) & _has_any(low, CHALLENGE_WORDS))
    fields = F.array_distinct(F.transform(f["fields"], field_meaning))
    one = F.try_element_at(fields, F.lit(1))
    case = (
        F.when((F.size(fields) == 0) & f["missing"], "missing")
        .when((F.size(fields) == 0) & f["hidden"], "hidden")
        .when(challenge, "challenge")
        .when(F.size(fields) == 0, "nothing")
        .when(F.size(fields) > 1, "conflict")
        .when(one["status"] == "unknown", "malformed")
        .otherwise("public")
    )
    cased = facts.withColumn("case", case).withColumn("one", one)
    ok = F.col("case").isin("missing", "hidden", "public")
    profile = F.when(ok, F.col("case")).otherwise("unknown")
    blog = F.when(F.col("case") == "public", F.col("one.status")).otherwise("unknown")
    url = F.when(F.col("case") == "public", F.col("one.url"))
    errors = {
        "challenge": "received a bot-challenge page instead of a user profile",
        "nothing": "known profile-state markers and the labelled blog field were not found",
        "conflict": "multiple conflicting labelled blog fields were found",
        "malformed": "the labelled blog field is malformed",
    }
    hint = F.when(F.col("case") == "nothing", F.left(F.col("f.text"), F.lit(512)))
    diagnostic = fingerprint(parser_version=F.lit(PARSER_VERSION), profile_status=F.lit("unknown"), reason=F.col("case"), hint=hint)
    return cased.select(
        *pages.columns,
        profile.alias("profile_status"),
        blog.alias("blog_status"),
        url.alias("blog_url"),
        F.when(F.col("case") == "public", F.col("one.raw")).alias("blog_url_raw"),
        F.when(ok, "ok").otherwise("parse_error").alias("check_result"),
        lookup(errors, F.col("case"), F.lit(None).cast("string")).alias("error"),
        F.when(ok, profile_fingerprint(profile, blog, url)).otherwise(diagnostic).alias("source_fingerprint"),
    )


def observations(fetched: DataFrame) -> DataFrame:
    """Observations of fetched pages (user_id, fetched_at, outcome, http_status, body, suspected_stale, error).

    Only pages that came through are parsed, and no text of a page that failed to parse is kept.
    """
    good = fetched.where("outcome = 'ok' and body is not null")
    rest = fetched.where("outcome <> 'ok' or body is null or outcome is null")
    parsed = classify_pages(good.withColumnRenamed("error", "fetch_error"))
    result = F.when((F.col("check_result") == "ok") & F.col("suspected_stale"), "suspected_stale").otherwise(F.col("check_result"))
    outcome = F.coalesce("outcome", F.lit("unknown"))
    common = ["user_id", F.col("fetched_at").alias("observed_at"), "http_status", F.lit(PARSER_VERSION).alias("parser_version")]
    ok = parsed.select(*common, "profile_status", "blog_status", "blog_url", "blog_url_raw", result.alias("check_result"), "error", "source_fingerprint")
    none = F.lit(None).cast("string")
    failed = rest.select(
        *common, F.lit("unknown").alias("profile_status"), F.lit("unknown").alias("blog_status"), none.alias("blog_url"), none.alias("blog_url_raw"),
        lookup(OUTCOME_RESULTS, outcome, F.lit("http_error")).alias("check_result"),
        F.coalesce("error", F.concat(F.lit("profile fetch failed: "), outcome)).alias("error"),
        fingerprint(parser_version=F.lit(PARSER_VERSION), profile_status=F.lit("unknown"), fetch_outcome=outcome).alias("source_fingerprint"),
    )
    return ok.unionByName(failed)


def link_status(status: Column, redirects: Column, mitigated: Column, body: Column) -> Column:
    """Health status of a link's last response."""
    challenge = F.coalesce(F.lower(mitigated) == "challenge", F.lit(False)) | _has_any(F.lower(F.coalesce(body, F.lit(""))), CHALLENGE_MARKS)
    return (
        F.when(status.isin(403, 429) | challenge, "blocked")
        .when(status.between(200, 299), F.when(redirects > 0, "redirected").otherwise("reachable"))
        .when(status.between(500, 599), "server_error")
        .otherwise("client_error")
    )


def transport_status(kinds: Column, message: Column) -> Column:
    """Health status of a request without a response, by its chain of exception kinds, then by its words."""
    low = F.lower(message)
    return (
        F.when(F.arrays_overlap(kinds, F.array(F.lit("ssl"), F.lit("certificate"))), "tls_error")
        .when(F.array_contains(kinds, "gaierror"), "dns_error")
        .when(_has_any(low, ("certificate", "tls", "ssl")), "tls_error")
        .when(_has_any(low, ("name or service not known", "nodename nor servname")), "dns_error")
        .otherwise("client_error")
    )


def screened(links: DataFrame) -> DataFrame:
    """links (url, addresses) with `blocked`: one forbidden answer blocks a host, and so does no answer."""
    each = links.select("url", F.explode_outer("addresses").alias("address"))
    verdict = each.withColumn("bad", is_forbidden("address")).groupBy("url").agg(F.max("bad").alias("blocked"))
    return links.join(verdict, "url")


WALK = "struct<at:string,seen:array<string>,redirects:int,status:string,http_status:int,error:string,done:boolean>"


def walk_redirects(links: DataFrame, most: int = 5) -> DataFrame:
    """url, final_url, redirect_count, status, http_status and error after a link's captured hops.

    hops: array of (status_code, location, cf_mitigated, body_prefix) in order. One function call makes all of a
    link's targets absolute and canonical; the decisions are a native fold over hops and targets.
    """
    located = F.transform("hops", lambda h: F.when(h["status_code"].isin(*REDIRECT_STATUSES), h["location"]))
    steps = F.arrays_zip(F.col("hops").alias("hop"), F.col("targets").alias("target"))
    none = F.lit(None).cast("string")
    start = F.struct(F.col("url").alias("at"), F.array("url").alias("seen"), F.lit(0).alias("redirects"), none.alias("status"), F.lit(None).cast("int").alias("http_status"), none.alias("error"), F.lit(False).alias("done")).cast(WALK)

    def step(w: Column, x: Column) -> Column:
        hop, target = x["hop"], x["target"]
        moved = hop["status_code"].isin(*REDIRECT_STATUSES)

        def end(status: Column, error: Column) -> Column:
            return F.struct(w["at"].alias("at"), w["seen"].alias("seen"), w["redirects"].alias("redirects"), status.alias("status"), hop["status_code"].alias("http_status"), error.alias("error"), F.lit(True).alias("done")).cast(WALK)

        def bad(message: str) -> Column:
            return end(F.lit("client_error"), F.lit(message))

        status = link_status(hop["status_code"], w["redirects"], hop["cf_mitigated"], hop["body_prefix"])
        error = (
            F.when(status == "blocked", "remote site blocked or challenged the automated request")
            .when(hop["status_code"].between(300, 399), "unhandled 3xx response")
            .when(~status.isin("reachable", "redirected"), F.concat(F.lit("HTTP "), hop["status_code"].cast("string")))
        )
        onward = F.struct(target.alias("at"), F.array_append(w["seen"], target).alias("seen"), (w["redirects"] + 1).alias("redirects"), none.alias("status"), F.lit(None).cast("int").alias("http_status"), none.alias("error"), F.lit(False).alias("done")).cast(WALK)
        return (
            F.when(w["done"], w)
            .when(~moved, end(status, error))
            .when(F.coalesce(hop["location"], F.lit("")) == "", bad("redirect response has no Location header"))
            .when(w["redirects"] >= most, bad("redirect limit exceeded"))
            .when(target.isNull(), end(F.lit("blocked"), F.lit("unsafe redirect target")))
            .when(F.array_contains(w["seen"], target), bad("redirect loop detected"))
            .otherwise(onward)
        )

    walked = links.withColumn("targets", resolve_chain("url", located)).select("url", F.aggregate(steps, start, step).alias("w"))
    w = F.col("w")
    lost = ~w["done"]
    return walked.select(
        "url", w["at"].alias("final_url"), w["redirects"].alias("redirect_count"), F.when(lost, "client_error").otherwise(w["status"]).alias("status"), w["http_status"].alias("http_status"),
        F.when(lost, "no response was captured").otherwise(w["error"]).alias("error"),
    )
