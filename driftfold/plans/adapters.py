"""Deterministic stand-ins for the domain tables over the star schema, in Spark and, as text, in DuckDB SQL.

Ids of the domain start at 1. Times are cut to seconds. Hosts end in .example.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftfold.functions.scalars import profile_fingerprint
from driftfold.schema import USER_COLUMNS

SITE = "https://site.example/user/"
NOW = "2026-03-01 00:00:00"
EPOCH_DAY = "2026-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations from events: views and purchases claim a blog, clicks none, signups a hidden profile; errors fail."""
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    kind, uid = F.col("event_type"), F.col("user_id") + 1
    failed = F.when(F.col("k") % 4 == 0, "timeout").when(F.col("k") % 4 == 1, "network_error").when(F.col("k") % 4 == 2, "parse_error").otherwise("http_error")
    result = F.when(kind == "error", failed).otherwise("ok")
    profile = F.when(kind.isin("view", "purchase", "click"), "public").when(kind == "signup", "hidden").otherwise("unknown")
    blog = F.when(kind.isin("view", "purchase"), "present").when(kind == "click", "absent").otherwise("unknown")
    url = F.when(kind == "view", F.concat(F.lit("https://b"), uid.cast("string"), F.lit(".example/"))).when(kind == "purchase", F.concat(F.lit("https://c"), uid.cast("string"), F.lit(".example/")))
    status = F.when(result.isin("ok", "parse_error"), 200).when(result == "http_error", 404)
    return rows.select(
        uid.alias("user_id"), F.col("event_id").alias("seq"), F.date_trunc("second", "ts").cast("timestamp_ntz").alias("observed_at"),
        profile.alias("profile_status"), blog.alias("blog_status"), url.alias("blog_url"), url.alias("blog_url_raw"),
        result.alias("check_result"), status.alias("http_status"), F.when(result != "ok", F.concat(F.lit("failed: "), result)).alias("error"), F.lit("1.0.0").alias("parser_version"),
    )


OBS_SQL = """
    obs0 as (select user_id + 1 as user_id, event_id as seq, date_trunc('second', ts) as observed_at, event_type as et,
                    cast(json_extract(props, '$.k') as integer) % 4 as k from events),
    obs as (select user_id, seq, observed_at,
                   case when et in ('view', 'purchase', 'click') then 'public' when et = 'signup' then 'hidden' else 'unknown' end as p,
                   case when et in ('view', 'purchase') then 'present' when et = 'click' then 'absent' else 'unknown' end as b,
                   case et when 'view' then 'https://b' || user_id || '.example/' when 'purchase' then 'https://c' || user_id || '.example/' end as u,
                   case when et <> 'error' then 'ok' when k = 0 then 'timeout' when k = 1 then 'network_error' when k = 2 then 'parse_error' else 'http_error' end as result
            from obs0)"""


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User records from customers."""
    k, uid = F.col("c_custkey"), (F.col("c_custkey") + 1).cast("string")
    profile = F.when(k % 20 == 0, "hidden").when(k % 20 == 1, "missing").when(k % 20 == 2, "unknown").otherwise("public")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", profile.alias("profile_status"))
    has = (F.col("profile_status") == "public") & (F.col("c_mktsegment") == "BUILDING")
    rows = rows.withColumn("blog_status", F.when(has, "present").when(F.col("profile_status") == "public", "absent").otherwise("unknown"))
    rows = rows.withColumn("blog_url", F.when(has, F.concat(F.lit("https://b"), F.col("c_nationkey").cast("string"), F.lit(".example/"))))
    rows = rows.withColumn("last_checked_at", F.lit(EPOCH_DAY).cast("timestamp_ntz") + F.make_dt_interval((k % 120).cast("int")))
    known = F.col("profile_status") != "unknown"
    first = F.col("last_checked_at") - F.make_dt_interval(F.lit(30))
    seen = F.when(known, F.col("last_checked_at") - F.make_dt_interval((k % 5).cast("int")))
    changed = F.when(known, first + F.make_dt_interval(F.when(k % 2 == 1, 20).otherwise(0)))
    failures = (k % 5).cast("long")
    result = F.when(failures == 0, "ok").when(k % 2 == 0, "timeout").otherwise("http_error")
    waiting = (k % 11 == 3) & (F.col("profile_status") == "public")
    pending_url = F.concat(F.lit("https://p"), uid, F.lit(".example/"))
    pending = F.struct(
        F.lit("present").alias("blog_status"), pending_url.alias("blog_url"), pending_url.alias("blog_url_raw"), F.lit(1).cast("long").alias("confirmations"), F.col("last_checked_at").alias("first_observed_at"), F.lit(200).alias("http_status"),
        F.col("last_checked_at").alias("last_observed_at"), F.lit("1.0.0").alias("parser_version"), F.lit("public").alias("profile_status"), profile_fingerprint(F.lit("public"), F.lit("present"), pending_url).alias("source_fingerprint"),
    )
    values = {
        "blog_changed_at": changed, "blog_status": F.col("blog_status"), "blog_url": F.col("blog_url"), "blog_url_raw": F.col("blog_url"), "consecutive_failures": failures, "first_checked_at": first,
        "http_status": F.when(failures == 0, 200).when(k % 2 == 1, 404), "id": k + 1, "last_check_result": result, "last_checked_at": F.col("last_checked_at"), "last_confirmed_at": seen, "last_error": F.when(failures > 0, result),
        "parser_version": F.lit("1.0.0"), "pending_observation": F.when(waiting, pending), "profile_changed_at": F.when(known, first), "profile_status": F.col("profile_status"), "profile_url": F.concat(F.lit(SITE), uid),
        "source_fingerprint": F.when(known, profile_fingerprint(F.col("profile_status"), F.col("blog_status"), F.col("blog_url"))),
    }
    return rows.select(*[values[name].cast(kind).alias(name) for name, kind in USER_COLUMNS.items()])


USERS_SQL = f"""
    u0 as (select c_custkey as k, c_custkey + 1 as id, c_nationkey as nk, c_mktsegment as seg,
                  case c_custkey % 20 when 0 then 'hidden' when 1 then 'missing' when 2 then 'unknown' else 'public' end as profile_status,
                  timestamp '{EPOCH_DAY}' + to_days(cast(c_custkey % 120 as integer)) as last_checked_at
           from customer),
    u1 as (select *, profile_status = 'public' and seg = 'BUILDING' as has, k % 11 = 3 and profile_status = 'public' as pending,
                  last_checked_at - interval 30 day as first_checked_at, cast(k % 5 as bigint) as consecutive_failures
           from u0),
    users as (select id, k, profile_status, last_checked_at, first_checked_at, pending, consecutive_failures,
                     case when has then 'present' when profile_status = 'public' then 'absent' else 'unknown' end as blog_status,
                     case when has then 'https://b' || nk || '.example/' end as blog_url,
                     case when consecutive_failures = 0 then 'ok' when k % 2 = 0 then 'timeout' else 'http_error' end as last_check_result,
                     case when profile_status <> 'unknown' then last_checked_at - to_days(cast(k % 5 as integer)) end as last_confirmed_at,
                     case when profile_status <> 'unknown' then first_checked_at end as profile_changed_at,
                     case when profile_status <> 'unknown' then first_checked_at + to_days(case when k % 2 = 1 then 20 else 0 end) end as blog_changed_at,
                     '{SITE}' || id as profile_url
              from u1)"""

# The order in which nations take health statuses.
HEALTH_ORDER = ("reachable", "redirected", "blocked", "timeout", "dns_error", "tls_error", "client_error", "server_error")


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link health from nations."""
    n = F.col("n_nationkey")
    status = F.element_at(F.array(*map(F.lit, HEALTH_ORDER)), (n % 8 + 1).cast("int"))
    well = n % 8 < 2
    url = F.concat(F.lit("https://b"), n.cast("string"), F.lit(".example/"))
    return table(spark, sf_dir, "nation").select(
        url.alias("url"), status.alias("status"), F.when(well, 0).otherwise(1 + n % 3).cast("long").alias("consecutive_failures"), (~well & (n % 2 == 1)).alias("failure_confirmed"),
        (F.lit(EPOCH_DAY).cast("timestamp_ntz") + F.make_dt_interval((n % 40).cast("int"))).alias("checked_at"),
        F.when(well, 200).when(n % 8 == 7, 503).when(n % 8 == 6, 404).when(n % 8 == 2, 403).cast("int").alias("http_status"),
        url.alias("final_url"), F.when(~well, status).alias("error"), F.lit(1).cast("long").alias("attempts"), F.when(n % 8 == 1, 1).otherwise(0).cast("long").alias("redirect_count"),
    )


HEALTH_SQL = f"""
    health as (select 'https://b' || n_nationkey || '.example/' as url, n_nationkey as n, n_nationkey % 8 < 2 as well,
                      ({list(HEALTH_ORDER)!r})[n_nationkey % 8 + 1] as status,
                      cast(case when n_nationkey % 8 < 2 then 0 else 1 + n_nationkey % 3 end as bigint) as consecutive_failures,
                      n_nationkey % 8 >= 2 and n_nationkey % 2 = 1 as failure_confirmed,
                      timestamp '{EPOCH_DAY}' + to_days(cast(n_nationkey % 40 as integer)) as checked_at,
                      case n_nationkey % 8 when 0 then 200 when 1 then 200 when 7 then 503 when 6 then 404 when 2 then 403 end as http_status,
                      cast(case n_nationkey % 8 when 1 then 1 else 0 end as bigint) as redirect_count
               from nation)"""


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events from orders."""
    status = F.col("o_orderstatus")
    kind = F.when(status == "P", "blog_added").when(status == "O", "blog_removed").otherwise("blog_changed")
    at = F.date_trunc("second", "o_orderdate").cast("timestamp_ntz")
    return table(spark, sf_dir, "orders").select((F.col("o_custkey") + 1).alias("user_id"), at.alias("changed_at"), kind.alias("kind"), F.concat(F.lit("e"), F.col("o_orderkey").cast("string")).alias("event_id"), F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("new_value"))


CHANGES_SQL = """
    changes as (select o_custkey + 1 as user_id, date_trunc('second', o_orderdate) as changed_at,
                       case o_orderstatus when 'P' then 'blog_added' when 'O' then 'blog_removed' else 'blog_changed' end as kind,
                       'e' || o_orderkey as event_id, o_orderkey as key, o_orderpriority as new_value from orders)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records from line items, one a month."""
    month = F.trunc("l_shipdate", "month")
    rows = table(spark, sf_dir, "lineitem").groupBy(month.alias("month")).agg(F.count("*").alias("attempted"), F.count_if(F.col("l_returnflag") == "R").alias("errors"))
    number = F.year("month") * 12 + F.month("month")
    started = F.col("month").cast("timestamp_ntz")
    return rows.select(
        F.concat(F.lit("run-"), F.date_format("month", "yyyy-MM")).alias("run_id"), F.lit("update").alias("mode"), started.alias("started_at"),
        F.when(number % 4 != 0, started + F.make_dt_interval(F.lit(1))).alias("finished_at"), F.lit(1).cast("long").alias("start_id"), F.lit("1.0").alias("crawler_version"), "attempted", "errors", number.cast("long").alias("number"),
    )


RUNS_SQL = """
    runs as (select 'run-' || strftime(m, '%Y-%m') as run_id, 'update' as mode, m as started_at, attempted, errors, n as number,
                    case when n % 4 <> 0 then m + interval 1 day end as finished_at
             from (select date_trunc('month', l_shipdate) as m, count(*) as attempted, count(*) filter (l_returnflag = 'R') as errors,
                          cast(year(date_trunc('month', l_shipdate)) * 12 + month(date_trunc('month', l_shipdate)) as bigint) as n
                   from lineitem group by 1))"""


def work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work lists from observations: a batch a user, in order of event_id; the row before is what is on record."""
    from pyspark.sql.window import Window

    rows = observations(spark, sf_dir)
    by = Window.partitionBy("user_id").orderBy("seq")
    prev = {"prev_result": "check_result", "prev_error": "error", "prev_parser_version": "parser_version", "prev_http_status": "http_status"}
    for name, source in prev.items():
        rows = rows.withColumn(name, F.lag(source).over(by))
    return (
        rows.withColumnRenamed("user_id", "batch")
        .withColumn("attempts", F.lit(1))
        .withColumn("prev_pending", F.lit(False))
        .withColumn("results", F.array(F.when(F.col("seq") % 101 == 7, "rate_limited").when(F.col("seq") % 211 == 9, "blocked_or_challenge").otherwise(F.col("check_result"))))
        .withColumn("is_probe", F.col("seq") % 9 == 0)
        .withColumn("n_events", F.when((F.col("blog_status") == "present") & (F.col("seq") % 3 == 0), 2).otherwise(0))
    )


WORK_SQL = f"""{OBS_SQL},
    work0 as (select user_id as batch, seq, observed_at, result, b, lag(result) over (partition by user_id order by seq) as prev from obs),
    work as (select batch, seq, observed_at, result, b, prev is not null and result <> 'ok' and prev = result as neutral,
                    case when seq % 101 = 7 then 'rate_limited' when seq % 211 = 9 then 'blocked_or_challenge' else result end as final,
                    seq % 9 = 0 as is_probe, case when b = 'present' and seq % 3 = 0 then 2 else 0 end as n_events from work0)"""
