"""The query catalogue: one query per operator family over the test tables, each with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftfold.functions import scalars as S
from driftfold.functions import web
from driftfold.operators import audit, merge, responses, safety, schedule, validate, views
from driftfold.plans import adapters as A
from driftfold.schema import SchedulePolicy
from driftfold.streaming import merge_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def now() -> F.Column:
    return F.lit(A.NOW).cast("timestamp_ntz")


ISO = "'%Y-%m-%dT%H:%M:%SZ'"

# ---------------------------------------------------------------- merge


def merge_sql(select: str, confirm: bool = True, source: str = "obs") -> str:
    """The fold as a recursive query, one observation of every entity a step."""
    return f"""
    with recursive {A.OBS_SQL},
    o as materialized (select *, row_number() over (partition by user_id order by observed_at, seq) as rn from {source}),
    f(user_id, rn, p, b, u, fails, result, first_at, last_at, conf_at, p_at, b_at, pp, pb, pu, pc, pfirst, plast, ev) as (
        select distinct user_id, 0::bigint, 'unknown', 'unknown', null::varchar, 0::bigint, null::varchar, null::timestamp, null::timestamp, null::timestamp, null::timestamp, null::timestamp,
               null::varchar, null::varchar, null::varchar, 0::bigint, null::timestamp, null::timestamp,
               []::struct(w timestamp, kind varchar, os varchar, ou varchar, ns varchar, nu varchar)[] from o
        union all
        select user_id, rn + 1, case when c then op else p end, case when c then ob else b end, case when c then ou else u end,
               case when ok then 0 else fails + 1 end, oresult, coalesce(first_at, t), t, case when c or r then t else conf_at end,
               case when c and (not base or p <> op) then t else p_at end, case when c and (not base or bdiff) then t else b_at end,
               case when not ok then pp when c or r then null when not m then op else pp end,
               case when not ok then pb when c or r then null when not m then ob else pb end,
               case when not ok then pu when c or r then null when not m then ou else pu end,
               case when not ok then pc when c or r then 0 else n end,
               case when not ok then pfirst when c or r then null when not m then t else pfirst end,
               case when not ok then plast when c or r then null when not m or late then t else plast end,
               case when c and base then ev
                    || (case when p <> op then [struct_pack(w := t, kind := 'profile_status', os := p, ou := null::varchar, ns := op, nu := null::varchar)] else [] end)
                    || (case when bdiff then [struct_pack(w := t, kind := case when b <> 'present' and ob = 'present' then 'blog_added' when b = 'present' and ob = 'absent' then 'blog_removed' else 'blog_changed' end,
                                              os := b, ou := u, ns := ob, nu := ou)] else [] end)
                    else ev end
        from (select *, ok and not r and (not need or n >= 2) as c from (
            select *, ok and base and p = op and not bdiff as r, {"base or ob = 'present'" if confirm else "false"} as need,
                   case when m then pc + case when late then 1 else 0 end else 1 end as n
            from (select f.*, o.p as op, o.b as ob, o.u as ou, o.result as oresult, o.observed_at as t, o.result = 'ok' as ok, f.conf_at is not null as base,
                         f.b <> o.b or f.u is distinct from o.u as bdiff,
                         coalesce(f.pp = o.p and f.pb = o.b and f.pu is not distinct from o.u, false) as m, coalesce(o.observed_at > f.plast, false) as late
                  from f join o on o.user_id = f.user_id and o.rn = f.rn + 1)))),
    done as (select f.* from f join (select user_id, max(rn) as rn from o group by user_id) z on z.user_id = f.user_id and z.rn = f.rn)
    {select}"""


STATE_SQL = f"""
    select user_id, p as profile_status, b as blog_status, u as blog_url, fails as consecutive_failures, result as last_check_result,
           strftime(first_at, {ISO}) as first_checked_at, strftime(last_at, {ISO}) as last_checked_at, strftime(conf_at, {ISO}) as last_confirmed_at,
           strftime(p_at, {ISO}) as profile_changed_at, strftime(b_at, {ISO}) as blog_changed_at,
           pb as pending_blog, pu as pending_url, case when pp is null then null else pc end as confirmations, strftime(plast, {ISO}) as pending_last, len(ev) as n_events
    from done"""


def state_rows(folded: DataFrame) -> DataFrame:
    s = F.col("state")
    p = s["pending_observation"]
    return folded.select(
        "user_id", s["profile_status"].alias("profile_status"), s["blog_status"].alias("blog_status"), s["blog_url"].alias("blog_url"), s["consecutive_failures"].alias("consecutive_failures"), s["last_check_result"].alias("last_check_result"),
        *[S.iso(s[c]).alias(c) for c in ("first_checked_at", "last_checked_at", "last_confirmed_at", "profile_changed_at", "blog_changed_at")],
        p["blog_status"].alias("pending_blog"), p["blog_url"].alias("pending_url"), p["confirmations"].alias("confirmations"), S.iso(p["last_observed_at"]).alias("pending_last"), F.size(s["events"]).cast("long").alias("n_events"),
    )


@query(f"with {A.OBS_SQL} select user_id, seq, strftime(observed_at, {ISO}) as observed_at, p as profile_status, b as blog_status, u as blog_url, result as check_result, result = 'ok' as successful from obs")
def q_observation_adapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.observations(spark, sf_dir)
    return rows.select("user_id", "seq", S.iso(F.col("observed_at")).alias("observed_at"), "profile_status", "blog_status", "blog_url", "check_result", (F.col("check_result") == "ok").alias("successful"))


@query(merge_sql(STATE_SQL))
def q_merge_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_rows(merge.fold_observations(A.observations(spark, sf_dir)))


@query(merge_sql(STATE_SQL, confirm=False))
def q_merge_no_confirm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_rows(merge.fold_observations(A.observations(spark, sf_dir), confirm_changes=False))


@query(merge_sql(STATE_SQL + " where pp is not null"))
def q_merge_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = merge.fold_observations(A.observations(spark, sf_dir))
    return state_rows(folded.where("state.pending_observation is not null"))


@query(merge_sql(STATE_SQL))
def q_merge_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second half of the observations folded over the records that the first half leaves."""
    obs = A.observations(spark, sf_dir)
    half = obs.agg(F.expr("percentile_approx(seq, 0.5)")).collect()[0][0]
    first = merge.fold_observations(obs.where(F.col("seq") <= half))
    before = merge.records(first, A.SITE)
    after = merge.fold_observations(obs.where(F.col("seq") > half), before)
    counted = first.select("user_id", F.size("state.events").cast("long").alias("earlier"))
    return state_rows(after).join(counted, "user_id", "left").withColumn("n_events", F.col("n_events") + F.coalesce("earlier", F.lit(0))).drop("earlier")


VALUE_SQL = """case when e.kind = 'profile_status' then '"' || e.{s}s || '"' else '{{"status":"' || e.{s}s || '","url":' || coalesce('"' || e.{s}u || '"', 'null') || '}}' end"""


@query(
    merge_sql(f"""
    , e as (select user_id, unnest(ev) as e from done),
    v as (select user_id, strftime(e.w, {ISO}) as changed_at, e.kind as kind, {VALUE_SQL.format(s="n")} as new_value, {VALUE_SQL.format(s="o")} as old_value from e)
    select *, substr(sha256('{{"changed_at":"' || changed_at || '","kind":"' || kind || '","new_value":' || new_value || ',"old_value":' || old_value || ',"user_id":' || user_id || '}}'), 1, 24) as event_id from v""")
)
def q_change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = merge.change_events(merge.fold_observations(A.observations(spark, sf_dir)))
    return events.select("user_id", S.iso(F.col("changed_at")).alias("changed_at"), "kind", "new_value", "old_value", "event_id")


@query(merge_sql(STATE_SQL, source="(select * from obs union all select * from obs)").replace("order by observed_at, seq", "order by observed_at, seq, copy").replace("(select * from obs union all select * from obs)", "(select *, 0 as copy from obs union all select *, 1 as copy from obs)"))
def q_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every observation seen twice: a replay is no second sighting."""
    obs = A.observations(spark, sf_dir)
    return state_rows(merge.fold_observations(obs.unionByName(obs)))


@query(merge_sql(STATE_SQL))
def q_stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_rows(merge_stream.replay(A.observations(spark, sf_dir)))


@query("""
    with c as (select event_id as seq, 'https://l' || user_id % 40 || '.example/' as url, case event_type when 'error' then 'timeout' when 'signup' then 'client_error' when 'click' then 'redirected' else 'reachable' end as status from events),
    l as (select url, max(seq) filter (status in ('reachable', 'redirected')) as well, arg_max(status, seq) as status, count(*) as checks from c group by url),
    n as (select c.url, count(*) as n from c join l using (url) where c.status not in ('reachable', 'redirected') and (well is null or c.seq > well) group by c.url)
    select url, status, coalesce(n, 0) as consecutive_failures, coalesce(n, 0) >= 2 as failure_confirmed, checks from l left join n using (url)""")
def q_link_failure_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    status = F.when(kind == "error", "timeout").when(kind == "signup", "client_error").when(kind == "click", "redirected").otherwise("reachable")
    url = F.concat(F.lit("https://l"), (F.col("user_id") % 40).cast("string"), F.lit(".example/"))
    return merge.fold_link_checks(A.table(spark, sf_dir, "events").select(url.alias("url"), F.col("event_id").alias("seq"), status.alias("status")))


# ---------------------------------------------------------------- views

SUMMARY_SQL = """
    select count(*) as record_count, coalesce(max(id), 0) as highest_attempted_id,
           coalesce(max(id) filter (last_confirmed_at is not null and profile_status in ('public', 'hidden')), 0) as highest_existing_user_id,
           coalesce(max(id) filter (last_confirmed_at is not null and profile_status in ('public', 'hidden')), 0) as highest_confirmed_user_id,
           count(*) filter (profile_status = 'public' and blog_status = 'present' and blog_url is not null) as blog_count,
           count(*) filter (profile_status = 'hidden') as n_hidden, count(*) filter (profile_status = 'missing') as n_missing,
           count(*) filter (profile_status = 'public') as n_public, count(*) filter (profile_status = 'unknown') as n_unknown from users"""


@query(f"with {A.USERS_SQL} {SUMMARY_SQL}")
def q_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.summary(A.users(spark, sf_dir))


@query(f"""with {A.USERS_SQL} select case when profile_status = 'unknown' then 'undecided' else profile_status end as status, count(*) as n,
    count(*) filter (profile_status = 'public' and blog_status = 'present' and blog_url is not null) as listed from users group by 1""")
def q_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.status_counts(A.users(spark, sf_dir))


LISTING_SQL = f"""with {A.USERS_SQL}, {A.HEALTH_SQL},
    listed as (select id, profile_url, blog_url, strftime(coalesce(last_confirmed_at, last_checked_at), {ISO}) as last_confirmed_at from users
               where profile_status = 'public' and blog_status = 'present' and blog_url is not null),
    shown as (select l.*, case when h.status is null then 'unchecked' when h.status not in ('reachable', 'redirected') and not h.failure_confirmed then 'pending_failure' else h.status end as health_status
              from listed l left join health h on h.url = l.blog_url),
    listing as (select *, case health_status {" ".join(f"when '{k}' then '{v}'" for k, v in S.HEALTH_LABELS.items())} else health_status end as label from shown)"""


@query(f"{LISTING_SQL} select * from listing")
def q_listing_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.listing(A.users(spark, sf_dir), A.health(spark, sf_dir))


@query(f"{LISTING_SQL} select id, id || ',' || profile_url || ',' || blog_url || ',' || health_status || ',' || last_confirmed_at as line from listing")
def q_csv_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.csv_lines(views.listing(A.users(spark, sf_dir), A.health(spark, sf_dir)))


@query(f"""{LISTING_SQL} select id, '| [' || id || '](' || profile_url || ') | [' || regexp_extract(blog_url, 'https://([^/]*)/', 1) || '](' || blog_url || ') | '
    || replace(label, '_', '\\_') || ' | ' || substr(last_confirmed_at, 1, 10) || ' |' as line from listing""")
def q_markdown_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.markdown_rows(views.listing(A.users(spark, sf_dir), A.health(spark, sf_dir)))


@query(r"""select page_id, replace(replace(regexp_replace(html, '([\\|\[\]*_`<>])', '\\\1', 'g'), chr(13), ' '), chr(10), '<br>') as escaped,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) || regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') as label from pages""")
def q_markdown_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "pages").select("page_id", S.markdown_escape(F.col("html")).alias("escaped"), S.blog_label(F.col("url")).alias("label"))


# ---------------------------------------------------------------- schedule

DUE_SQL = f"""{A.USERS_SQL},
    d0 as (select *, coalesce(last_confirmed_at, last_checked_at) as seen,
                  coalesce(last_confirmed_at, last_checked_at) + to_days(case when profile_status = 'public' and blog_status = 'present' then 1 when profile_status = 'public' and blog_status = 'absent' then 3 when profile_status in ('hidden', 'missing') then 6 else 1 end) as regular,
                  greatest(case when profile_changed_at > first_checked_at then profile_changed_at end, case when blog_changed_at > first_checked_at then blog_changed_at end) as changed
           from users),
    due as (select id, profile_status, case when pending then 0 when last_check_result <> 'ok' then 1 when profile_status = 'unknown' then 2 when blog_status = 'present' then 3 when profile_status = 'public' then 4 when profile_status = 'hidden' then 5 else 6 end as category,
                   case when pending then last_checked_at + interval 24 hour
                        when last_check_result <> 'ok' then last_checked_at + to_hours(cast(least(24 * power(2, least(consecutive_failures - 1, 16)), 72) as integer))
                        when changed is not null and seen <= changed then least(regular, changed + interval 7 day) else regular end as due_at
            from d0)"""


@query(f"with {DUE_SQL} select id, category, strftime(due_at, {ISO}) as due_at, due_at <= timestamp '{A.NOW}' as due from due")
def q_due_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = schedule.with_due(A.users(spark, sf_dir))
    return rows.select("id", "category", S.iso(F.col("due_at")).alias("due_at"), (F.col("due_at") <= now()).alias("due"))


@query(f"with {DUE_SQL} select id, category, strftime(due_at, {ISO}) as due_at from due where due_at <= timestamp '{A.NOW}' order by category, due.due_at, id limit 500")
def q_due_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule.due_users(A.users(spark, sf_dir), now()).select("id", "category", S.iso(F.col("due_at")).alias("due_at"))


@query(f"""with {A.USERS_SQL}, {A.HEALTH_SQL},
    d as (select u.url, case when h.url is null then timestamp '1970-01-01' when h.well then h.checked_at + interval 30 day else h.checked_at + to_hours(cast(24 * least(h.consecutive_failures, 3) as integer)) end as due_at
          from (select distinct blog_url as url from users where profile_status = 'public' and blog_status = 'present' and blog_url is not null) u left join health h on h.url = u.url)
    select url, strftime(due_at, {ISO}) as due_at from d where due_at <= timestamp '{A.NOW}' order by d.due_at, url limit 200""")
def q_link_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = A.users(spark, sf_dir).where(S.blog_present()).select(F.col("blog_url").alias("url"))
    return schedule.due_links(urls, A.health(spark, sf_dir), now()).select("url", S.iso(F.col("due_at")).alias("due_at"))


FRONTIER_SQL = """f as (select coalesce(max(id) filter (last_confirmed_at is not null and profile_status in ('public', 'hidden')), 0) + 1 as frontier from users),
    probes as (select cast(i as bigint) as seq, cast(frontier + i % 256 as bigint) as id from f, range(64) r(i))"""


@query(f"with {A.USERS_SQL}, {FRONTIER_SQL} select seq, id from probes")
def q_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule.frontier_probes(A.users(spark, sf_dir), cursor=0)


@query(f"""with {DUE_SQL}, {FRONTIER_SQL},
    top as (select * from due where due_at <= timestamp '{A.NOW}' order by category, due_at, id limit 500)
    select seq, id, true as is_probe from probes
    union all select row_number() over (order by category, due_at, id) + 63, id, false from top where id not in (select id from probes)""")
def q_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule.work_list(A.users(spark, sf_dir), now(), cursor=0)


TAIL_SQL = """tail as (select id, case when id > (select max(id) - 60 from users) then 'missing' else profile_status end as profile_status,
                              case when id > (select max(id) - 60 from users) then timestamp '2026-01-01' else last_confirmed_at end as last_confirmed_at
                       from users where id <> (select max(id) - 9 from users)),
    top as (select coalesce(max(id) filter (last_confirmed_at is not null and profile_status in ('public', 'hidden')), 0) as h from tail)"""


@query(f"""with {A.USERS_SQL}, {TAIL_SQL},
    m as (select id, id - row_number() over (order by id) as island from tail, top where id > h and last_confirmed_at is not null and profile_status = 'missing')
    select h as highest_existing, (select count(*) from m where island = (select h from top)) as trailing, (select count(*) from m where island = (select h from top)) >= 256 as boundary_reached from top""")
def q_trailing_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over users whose last 60 ids are missing, one of them without a row."""
    rows = A.users(spark, sf_dir)
    top = rows.agg(F.max("id").alias("top"))
    marked = rows.crossJoin(F.broadcast(top)).where(F.col("id") != F.col("top") - 9)
    late = F.col("id") > F.col("top") - 60
    marked = marked.withColumn("profile_status", F.when(late, "missing").otherwise(F.col("profile_status"))).withColumn("last_confirmed_at", F.when(late, F.lit(A.EPOCH_DAY).cast("timestamp_ntz")).otherwise(F.col("last_confirmed_at")))
    return schedule.trailing_missing(marked)


@query("""with i as (select o_orderkey + 1 as id from orders where o_orderkey % 7 <> 3 and o_orderkey % 31 not in (5, 6)),
    g as (select id, lag(id, 1, 0) over (order by id) as prev from i)
    select prev + 1 as first, id - 1 as last, case when prev + 1 = id - 1 then cast(prev + 1 as varchar) else (prev + 1) || '-' || (id - 1) end as label from g where id - prev > 1""")
def q_coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return schedule.coverage_gaps(A.table(spark, sf_dir, "orders").where((k % 7 != 3) & ~(k % 31).isin(5, 6)).select((k + 1).alias("id")))


@query("""with r as (select l_partkey as part, l_suppkey as id, l_orderkey * 8 + l_linenumber as pos from lineitem),
    m as (select *, lag(id) over (partition by part order by pos, id) as prev, row_number() over (partition by part, id order by pos) as nth from r)
    select part, id, pos, 'duplicate_id' as code from m where nth > 1 union all select part, id, pos, 'record_order' from m where id <= prev""")
def q_order_dup_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("id"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pos"))
    return schedule.order_faults(rows, "id", "pos", ["part"])


# ---------------------------------------------------------------- safety


def streak_sql(neutral: str, failing: str) -> str:
    return f"""isl as (select *, {neutral} as nt, sum(case when not ({neutral}) and not ({failing}) then 1 else 0 end) over (partition by batch order by seq) as island from work),
    st as (select *, cast(sum(case when not nt and ({failing}) then 1 else 0 end) over (partition by batch, island order by seq) as bigint) as streak from isl)"""


TRANSIENT = "result in ('http_error', 'network_error', 'server_error', 'timeout')"


@query(f"with {A.WORK_SQL}, {streak_sql('neutral', TRANSIENT)} select batch, seq, result as check_result, streak from st")
def q_safety_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.work(spark, sf_dir)
    done = safety.streaks(rows, ["batch"], F.col("check_result").isin("http_error", "network_error", "server_error", "timeout"), safety.stable_known_failure())
    return done.select("batch", "seq", "check_result", "streak")


@query(f"with {A.WORK_SQL}, {streak_sql('false', TRANSIENT)} select batch, min(seq) filter (streak >= 2) as stop_seq, max(streak) as longest from st group by batch")
def q_bootstrap_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.work(spark, sf_dir)
    done = safety.streaks(rows, ["batch"], F.col("check_result").isin("http_error", "network_error", "server_error", "timeout"), F.lit(False))
    return done.groupBy("batch").agg(F.min(F.when(F.col("streak") >= 2, F.col("seq"))).alias("stop_seq"), F.max("streak").alias("longest"))


MASS_SQL = """mc as (select *, count(*) over w as attempted, cast(sum(case when n_events > 0 then 1 else 0 end) over w as bigint) as changed_users
               from work where not is_probe window w as (partition by batch order by seq rows between unbounded preceding and current row)),
    mt as (select *, attempted >= 20 and changed_users >= 10 and changed_users >= attempted * 0.25 as tripped from mc)"""


@query(f"with {A.WORK_SQL}, {MASS_SQL} select batch, seq, attempted, changed_users, tripped from mt")
def q_mass_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.work(spark, sf_dir).where(~F.col("is_probe"))
    return safety.mass_change(rows, ["batch"]).select("batch", "seq", "attempted", "changed_users", "tripped")


STOP_SQL = f"""{A.WORK_SQL}, {MASS_SQL},
    ip as (select *, sum(case when not neutral and result not in ('parse_error', 'suspected_stale') then 1 else 0 end) over (partition by batch order by seq) as island from work),
    sp as (select *, sum(case when not neutral and result in ('parse_error', 'suspected_stale') then 1 else 0 end) over (partition by batch, island order by seq) as streak from ip),
    {streak_sql("neutral", TRANSIENT)},
    trips as (select b.batch, (select min(seq) from work w where w.batch = b.batch and final in ('rate_limited', 'blocked_or_challenge')) as fatal,
                     (select min(seq) from sp w where w.batch = b.batch and streak >= 5) as parse, (select min(seq) from st w where w.batch = b.batch and streak >= 10) as transient,
                     (select min(seq) from mt w where w.batch = b.batch and tripped) as mass from (select distinct batch from work) b),
    stops as (select batch, least(fatal, parse, transient, mass) as stop_seq,
                     case least(fatal, parse, transient, mass) when fatal then 'fatal' when parse then 'parse' when transient then 'transient' when mass then 'mass_change' end as stop_reason from trips)"""


def work_with_neutral(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.work(spark, sf_dir).withColumn("neutral", safety.stable_known_failure())


@query(f"with {STOP_SQL} select s.batch, s.stop_seq, s.stop_reason, count(*) as committed from stops s join work w on w.batch = s.batch and (s.stop_seq is null or w.seq <= s.stop_seq) group by all")
def q_stop_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = work_with_neutral(spark, sf_dir)
    stops = safety.stop_row(rows, ["batch"])
    kept = safety.prefix(rows, stops, ["batch"]).groupBy("batch").agg(F.count("*").alias("committed"))
    return stops.join(kept, "batch")


@query(f"""with {A.WORK_SQL} select strftime(observed_at, '%Y-%m-%d') as day, count(*) as attempted, count(*) filter (result = 'ok') as confirmed, cast(sum(n_events) as bigint) as changed,
    count(*) filter (final <> 'ok') as errors, count(*) filter (final = 'rate_limited') as rate_limited, arg_max(batch, seq) as end_id from work group by 1""")
def q_run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.work(spark, sf_dir).withColumn("day", F.date_format("observed_at", "yyyy-MM-dd")).withColumn("confirmed", F.col("check_result") == "ok")
    return safety.run_counters(rows.withColumnRenamed("batch", "user_id"), ["day"])


@query(f"""with {A.USERS_SQL} select greatest(700, coalesce(max(id), 0)) as highest_attempted_id,
    greatest(200, coalesce(max(id) filter (last_confirmed_at is not null and profile_status in ('public', 'hidden')), 0)) as highest_confirmed_user_id from users""")
def q_advance_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.users(spark, sf_dir).select("id", S.existing().alias("is_existing"))
    return safety.advance_state(rows, 700, 200)


# ---------------------------------------------------------------- storage


@query("""with s as (select (c_custkey + 1) // 1000 * 1000 as start, count(*) as n, min(c_custkey + 1) as low, max(c_custkey + 1) as high from customer group by 1)
    select start as shard_start, lpad(cast(start as varchar), 5, '0') || '-' || lpad(cast(start + 999 as varchar), 5, '0') || '.jsonl' as file, n, low, high from s""")
def q_shard_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.users(spark, sf_dir).select("id", S.shard_start(F.col("id")).alias("shard_start"), S.shard_name(F.col("id")).alias("file"))
    return rows.groupBy("shard_start", "file").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))


@query(f"""with {A.USERS_SQL}, new as (select id, 'changed' as last_error from users where profile_status = 'hidden')
    select id, case when profile_status = 'x' then '' else case when consecutive_failures > 0 then last_check_result end end as last_error from users where id not in (select id from new)
        and id // 1000 in (select id // 1000 from new)
    union all select * from new""")
def q_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hidden records changed: the rows of the shards that touches."""
    old = A.users(spark, sf_dir)
    new = old.where("profile_status = 'hidden'").withColumn("last_error", F.lit("changed"))
    return audit.upsert_shards(old, new, 1000).select("id", "last_error")


AUDIT_SQL = f"""with {A.CHANGES_SQL}, old as (select * from changes where key % 3 <> 0), new as (select * from changes where key % 2 = 0)"""


@query(f"{AUDIT_SQL} select event_id, user_id, strftime(changed_at, {ISO}) as changed_at, kind, new_value from old union select event_id, user_id, strftime(changed_at, {ISO}), kind, new_value from new")
def q_audit_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.changes(spark, sf_dir)
    merged = audit.append_events(rows.where("key % 3 <> 0"), rows.where("key % 2 = 0"))
    return merged.select("event_id", "user_id", S.iso(F.col("changed_at")).alias("changed_at"), "kind", "new_value")


@query(f"""{AUDIT_SQL} select n.event_id, case when n.key % 10 = 4 and o.event_id is not null then 'conflict' when o.event_id is null then 'insert' else 'noop' end as action
    from new n left join old o on o.event_id = n.event_id""")
def q_audit_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.changes(spark, sf_dir)
    new = rows.where("key % 2 = 0").withColumn("new_value", F.when(F.col("key") % 10 == 4, "mutated").otherwise(F.col("new_value")))
    return audit.classify_append(rows.where("key % 3 <> 0"), new)


@query(f"""with {A.RUNS_SQL}, old as (select * from runs where number % 3 <> 0)
    select n.run_id, case when o.run_id is null then 'insert' when n.number % 5 = 0 then 'conflict' when o.finished_at is null and n.number % 2 = 0 then 'finalize' else 'noop' end as action
    from runs n left join old o using (run_id)""")
def q_run_finalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New run rows against old ones: unfinished runs of even months are finished, every fifth one changes its mode."""
    rows = A.runs(spark, sf_dir)
    end = F.col("started_at") + F.make_dt_interval(F.lit(2))
    new = rows.withColumn("mode", F.when(F.col("number") % 5 == 0, "other").otherwise(F.col("mode"))).withColumn("finished_at", F.when(F.col("finished_at").isNull() & (F.col("number") % 2 == 0), end).otherwise(F.col("finished_at")))
    return audit.classify_runs(rows.where("number % 3 <> 0"), new)


@query("select event_id, user_id, event_type from events qualify row_number() over (partition by user_id order by event_id desc) = 1")
def q_latest_per_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.latest(A.table(spark, sf_dir, "events"), "user_id", "event_id").select("event_id", "user_id", "event_type")


@query(f"with {A.CHANGES_SQL}, {A.USERS_SQL} select user_id, event_id from changes c where not exists (select 1 from users u where u.id = c.user_id and u.id % 3 <> 0) order by user_id, event_id limit 20")
def q_orphan_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = A.users(spark, sf_dir).where("id % 3 <> 0")
    return audit.orphans(A.changes(spark, sf_dir), kept, 20).select("user_id", "event_id")


# ---------------------------------------------------------------- validation


def faulty_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User records with one fault in every eleventh row, of nine kinds in turn."""
    rows = A.users(spark, sf_dir)
    pick = lambda n: (F.col("id") % 11 == 0) & (F.floor(F.col("id") / 11) % 9 == n)
    swap = lambda c, n, value: F.when(pick(n), value).otherwise(F.col(c)).alias(c)
    changed = {
        "profile_url": swap("profile_url", 0, F.lit("https://site.example/user/0")), "http_status": swap("http_status", 1, F.lit(99)), "parser_version": swap("parser_version", 2, F.lit("bad version")),
        "first_checked_at": swap("first_checked_at", 3, F.col("last_checked_at") + F.make_dt_interval(F.lit(1))), "consecutive_failures": F.when(pick(4) & (F.col("last_check_result") == "ok"), F.lit(3)).otherwise(F.col("consecutive_failures")).cast("long").alias("consecutive_failures"),
        "source_fingerprint": swap("source_fingerprint", 5, F.lit("ABC")), "last_checked_at": F.when(pick(6), F.lit(None)).otherwise(F.col("last_checked_at")).alias("last_checked_at"),
        "last_confirmed_at": F.when(pick(7), F.lit(None)).otherwise(F.col("last_confirmed_at")).alias("last_confirmed_at"), "blog_url_raw": swap("blog_url_raw", 8, F.lit("https://x.example/")),
    }
    return rows.select(*[changed.get(c, F.col(c)) for c in rows.columns])


@query(f"""with {A.USERS_SQL}, g as (select *, case when id % 11 = 0 then (id // 11) % 9 else -1 end as fault from users)
    select id as user_id, 'profile_url' as code from g where fault = 0
    union all select id, 'http_status' from g where fault = 1
    union all select id, 'parser_version' from g where fault = 2
    union all select id, 'timestamp_order' from g where fault = 3
    union all select id, 'failure_count' from g where fault = 4 and last_check_result = 'ok'
    union all select id, 'fingerprint' from g where fault = 5 and profile_status <> 'unknown'
    union all select id, 'fingerprint' from g where fault = 5 and profile_status = 'unknown'
    union all select id, 'fingerprint' from g where fault = 5 and profile_status <> 'unknown'
    union all select id, 'fingerprint' from g where fault = 5 and profile_status = 'unknown'
    union all select id, 'attempt_timestamps' from g where fault = 6
    union all select id, 'unconfirmed_state' from g where fault = 7 and profile_status <> 'unknown'
    union all select id, 'absent_blog_url' from g where fault = 8 and profile_status = 'public' and blog_status = 'absent'
    union all select id, 'profile_blog_url' from g where fault = 8 and profile_status <> 'public'""")
def q_validate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate_users(faulty_users(spark, sf_dir)).select("user_id", "code")


@query(f"""with {A.USERS_SQL}, s as ({SUMMARY_SQL}),
    e as (unpivot (select blog_count, highest_attempted_id, highest_confirmed_user_id, highest_existing_user_id, n_hidden, n_missing, n_public, n_unknown, record_count from s) on columns(*) into name field value expected)
    select field, expected, cast(expected + case field when 'blog_count' then 1 when 'n_hidden' then 2 else 0 end as bigint) as actual from e where field in ('blog_count', 'n_hidden')""")
def q_validate_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest with two stale counts."""
    rows = A.users(spark, sf_dir)
    manifest = views.summary(rows).withColumn("blog_count", F.col("blog_count") + 1).withColumn("n_hidden", F.col("n_hidden") + 2)
    return validate.manifest_mismatches(rows, manifest)


STATE_RULES_SQL = {
    "state_frontier": ["confirmed > attempted"],
    "state_boundary": ["pending and candidate is null", "bounding and (candidate is null or not pending)", "not bounding and (candidate is not null or pending)"],
    "state_pause": ["phase = 'paused' and paused_from is null", "phase <> 'paused' and paused_from is not null"],
    "state_next_id": ["next_id <= confirmed"],
    "state_boundary_range": ["candidate < 1", "candidate > attempted"],
    "state_dataset_mismatch": ["attempted <> highest_attempted_id", "confirmed <> highest_existing_user_id"],
    "state_next_id_gap": ["next_id > highest_attempted_id + 1"],
    "state_manifest_mismatch": ["attempted <> highest_attempted_id", "confirmed <> highest_confirmed_user_id", "phase <> m_phase"],
    "state_manifest_status": [
        "not ((phase = 'bootstrap' and status in ('not_started', 'in_progress')) or (phase = 'boundary_confirmation' and status = 'in_progress') or (phase = 'maintenance' and status = 'complete') or (phase = 'paused' and status = 'paused'))",
        "status = 'not_started'",
    ],
}


@query(f"""with {A.USERS_SQL}, s as ({SUMMARY_SQL}),
    o as (select *, ['bootstrap', 'boundary_confirmation', 'maintenance', 'paused'][o_orderkey % 4 + 1] as phase, case when o_orderkey % 5 > 0 then ['maintenance', 'boundary_confirmation', 'bootstrap'][o_orderkey % 3 + 1] end as paused_from,
        highest_attempted_id - o_orderkey % 2 as attempted, highest_existing_user_id + case when o_orderkey % 7 = 0 then 5000 else 0 end as confirmed, case o_orderkey % 11 when 0 then 0 when 1 then highest_attempted_id + 100 else highest_attempted_id + 1 end as next_id,
        case o_orderkey % 6 when 0 then null when 1 then -1 when 2 then 1000000000 else 5 end as candidate, o_orderkey // 2 % 2 = 0 as pending from orders, s),
    p as (select *, phase = 'boundary_confirmation' or coalesce(phase = 'paused' and paused_from = 'boundary_confirmation', false) as bounding from o, (values ('maintenance', 'complete'), ('bootstrap', 'not_started')) t(m_phase, status)),
    f as (select unnest([{", ".join(f"case when {rule} then '{code}' end" for code, rules in STATE_RULES_SQL.items() for rule in rules)}]) as code from p)
    select code, case when code = 'state_next_id' then 'warning' else 'error' end as severity, count(*) as n from f where code is not null group by code""")
def q_validate_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control rows of all mixes of sound and unsound fields, one for each order, against two manifests."""
    rows = A.users(spark, sf_dir)
    key, top = F.col("o_orderkey"), F.col("highest_attempted_id")
    pick = lambda n, *values: F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))
    state = A.table(spark, sf_dir, "orders").crossJoin(F.broadcast(views.summary(rows))).select(
        pick(key, "bootstrap", "boundary_confirmation", "maintenance", "paused").alias("phase"), F.when(key % 5 > 0, pick(key, "maintenance", "boundary_confirmation", "bootstrap")).alias("paused_from_phase"),
        (top - key % 2).alias("highest_attempted_id"), (F.col("highest_existing_user_id") + F.when(key % 7 == 0, 5000).otherwise(0)).alias("highest_confirmed_user_id"),
        F.when(key % 11 == 0, 0).when(key % 11 == 1, top + 100).otherwise(top + 1).alias("next_id"), pick(key, None, -1, 1_000_000_000, 5, 5, 5).cast("long").alias("boundary_candidate_start"), (F.floor(key / 2) % 2 == 0).alias("boundary_confirmation_pending"),
    )
    each = F.explode(F.array(*[F.struct(F.lit(phase).alias("phase"), F.lit(status).alias("initialization_status")) for phase, status in (("maintenance", "complete"), ("bootstrap", "not_started"))]))
    manifests = views.summary(rows).withColumn("m", each).select("*", "m.*").drop("m")
    return validate.validate_state(state, manifests, rows).groupBy("code", "severity").agg(F.count("*").alias("n"))


#: What is planted in the health row of each nation: field, value, and the codes that must come of it.
HEALTH_FAULTS = {
    0: ("redirect_count", 2, ["health_redirects"]), 1: ("redirect_count", 0, ["health_redirects"]), 2: ("attempts", 0, ["health_attempts"]), 3: ("http_status", 200, ["health_http_status"]),
    4: ("consecutive_failures", 0, ["health_failures"]), 5: ("error", " ", ["health_error"]), 6: ("http_status", 500, ["health_http_status"]), 7: ("http_status", 404, ["health_http_status"]), 8: ("http_status", 304, ["health_healthy"]),
    9: ("error", "x", ["health_healthy"]), 10: ("failure_confirmed", False, ["health_confirmed"]), 11: ("error", "x" * 501, ["health_error"]), 12: ("redirect_count", -1, ["health_redirects"]), 13: ("consecutive_failures", -1, ["health_failures"] * 2),
    14: ("final_url", "https://x.example", ["health_final_url"]), 15: ("status", "odd", ["health_status"]), 16: ("consecutive_failures", 1, ["health_healthy"]), 17: ("final_url", None, ["health_healthy"]), 18: ("final_url", "http://127.0.0.1/", []),
    19: ("url", "http://127.0.0.1/", ["health_url"]), 20: ("http_status", 99, ["health_http_status"] * 2), 21: ("final_url", "http://127.0.0.1/", ["health_final_url"]), 22: ("http_status", 403, ["health_http_status"]),
}


@query(f"""select case when n = 19 then 'http://127.0.0.1/' else 'https://b' || n || '.example/' end as url, code
    from nation join (values {", ".join(f"({n}, '{code}')" for n, (_, _, codes) in HEALTH_FAULTS.items() for code in codes)}) t(n, code) on n = n_nationkey""")
def q_health_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound health rows with one fault planted in each of the first nations."""
    rows = A.health(spark, sf_dir).withColumn("n", F.regexp_extract("url", "[0-9]+", 0).cast("int")).withColumn("failure_confirmed", F.col("consecutive_failures") >= 2)
    planted = {}
    for n, (field, value, _) in HEALTH_FAULTS.items():
        planted[field] = F.when(F.col("n") == n, F.lit(value)).otherwise(planted.get(field, F.col(field)))
    return validate.validate_health(rows.withColumns(planted)).select("url", "code")


@query("""with k as (select event_id, json_keys(props) as ks from events)
    select 'unknown_field' as code, count(*) as n from k, unnest(ks) union all select 'missing_fields', count(*) from k""")
def q_field_set_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("path"), F.col("props").alias("line"))
    return validate.field_issues(rows).groupBy("code").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- encodings and text


@query(f"""with {A.USERS_SQL}, j as (select id, '{{"blog_status":"' || blog_status || '","blog_url":' || coalesce('"' || blog_url || '"', 'null') || ',"profile_status":"' || profile_status || '"}}' as line from users)
    select id, line, sha256(line) as fingerprint from j""")
def q_canonical_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {c: F.col(c) for c in ("profile_status", "blog_status", "blog_url")}
    return A.users(spark, sf_dir).select("id", S.canonical_json(**fields).alias("line"), S.profile_fingerprint(*fields.values()).alias("fingerprint"))


@query(f"""select event_id, strftime(ts, {ISO}) as iso, cast(year(ts) as integer) as year, strftime(ts, '%Y-%m-%d') as day,
    cast(case event_id % 3 when 0 then event_id % 100 when 1 then greatest(0, epoch(timestamp '2026-03-01 00:00:30') - epoch(timestamp '{A.NOW}')) end as double) as retry_after from events""")
def q_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    header = F.when(e % 3 == 0, (e % 100).cast("string")).when(e % 3 == 1, "Sun, 01 Mar 2026 00:00:30 GMT").otherwise("soon")
    iso = S.iso(F.col("ts"))
    return A.table(spark, sf_dir, "events").select("event_id", iso.alias("iso"), F.year(S.parse_iso(iso)).alias("year"), S.short_date(iso).alias("day"), S.retry_after_seconds(header, now()).alias("retry_after"))


@query(r"""select doc_id, substr(trim(regexp_replace(text, '[\s\x0b\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'), ' '), 1, 500) as error,
    substr(trim(regexp_replace(text, '[\s\x0b\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'), ' '), 1, 240) as short_error from documents""")
def q_sanitize_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "documents").select("doc_id", S.sanitize_error(F.col("text")).alias("error"), S.sanitize_error(F.col("text"), 240).alias("short_error"))


@query(r"""with v as (select page_id, url, 'HTTPS://' || upper(regexp_extract(url, '://([^/:?#]*)', 1)) || '.:443' || regexp_extract(url, '://[^/?#]*(.*)$', 1) || '#part' as odd from pages)
    select page_id, lower(regexp_extract(url, '^([a-z]+)://', 1)) || '://' || lower(regexp_extract(url, '://([^/?#]*)', 1)) || case when regexp_extract(url, '://[^/?#]*([^?#]*)', 1) = '' then '/' else '' end || regexp_extract(url, '://[^/?#]*(.*)$', 1) as plain,
           'https://' || lower(regexp_extract(url, '://([^/:?#]*)', 1)) || case when regexp_extract(url, '://[^/?#]*([^?#]*)', 1) = '' then '/' else '' end || regexp_extract(url, '://[^/?#]*(.*)$', 1) || '#part' as odd,
           cast(null as varchar) as credentials from v""")
def q_url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    rest, host = F.regexp_extract(url, "://[^/?#]*(.*)$", 1), F.regexp_extract(url, "://([^/:?#]*)", 1)
    odd = F.concat(F.lit("HTTPS://"), F.upper(host), F.lit(".:443"), rest, F.lit("#part"))
    return A.table(spark, sf_dir, "pages").select("page_id", S.normalize_url(url).alias("plain"), S.normalize_url(odd).alias("odd"), S.normalize_url(F.concat(F.lit("http://u:p@"), host, F.lit("/"))).alias("credentials"))


@query()
def q_url_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return A.table(spark, sf_dir, "pages").select("page_id", web.publish_url(url).alias("published"), web.check_url(F.concat(url, F.lit("#x"))).alias("checked"), web.publish_url(F.concat(F.lit(" "), url, F.lit("%0a"))).alias("unsafe"))


@query()
def q_html_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification of pages, a labelled field of each kind put into some of them."""
    field = F.when(F.col("page_id") % 4 == 0, f'<li>博客：<a href="https://blog.example/">blog.example</a></li>').when(F.col("page_id") % 4 == 1, "<li>博客: 暂无</li>").when(F.col("page_id") % 4 == 2, f"<p>{web.MISSING_TEXT}</p>").otherwise("")
    pages = A.table(spark, sf_dir, "pages").select("page_id", F.concat(field, F.col("html")).alias("body"))
    return responses.classify_pages(pages).drop("body")


def captured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured page requests from events, one kind of answer for each id modulo 16."""
    e = F.col("event_id")
    kind = e % 16
    status = F.element_at(F.array(*map(F.lit, (200, 301, 403, 429, 408, 503, 404, 200, 200, 200, 200, 500, 425, 401, 200, 200))), (kind + 1).cast("int"))
    return A.table(spark, sf_dir, "events").select(
        e.alias("event_id"), (kind != 8).alias("robots_allowed"), F.when(e % 32 == 8, 403).otherwise(500).alias("robots_status"), (kind != 9).alias("exact_allowed"), F.when(kind == 10, F.when(e % 32 == 10, "timeout").otherwise("reset")).alias("exception"), status.alias("http_status"),
        F.when(kind == 14, "<p>verify you are human</p> captcha").otherwise("<p>ok</p>").alias("body"), F.when(kind == 15, 2_000_001).otherwise(10).alias("body_bytes"), F.when(kind == 7, "application/json").otherwise("text/html; charset=utf-8").alias("content_type"),
        F.when(e % 5 == 0, "hit").alias("cf"), F.when(e % 7 == 0, (e % 3).cast("string")).alias("age"), F.when(e % 11 == 0, "Stale from x").alias("x_cache"), F.when(e % 13 == 0, "110 stale").alias("warning"),
    )


@query("""with e as (select event_id, event_id % 16 as k from events),
    o as (select event_id, k, case k when 8 then case when event_id % 32 = 8 then 'robots_disallowed' else 'robots_unavailable' end when 9 then 'robots_disallowed' when 10 then case when event_id % 32 = 10 then 'timeout' else 'network_error' end
        when 15 then 'response_too_large' when 1 then 'redirect_rejected' when 2 then 'blocked_or_challenge' when 13 then 'blocked_or_challenge' when 14 then 'blocked_or_challenge' when 3 then 'rate_limited' when 4 then 'http_error' when 12 then 'http_error'
        when 5 then 'server_error' when 11 then 'server_error' when 6 then 'http_error' when 7 then 'invalid_content_type' else 'ok' end as outcome from e)
    select event_id, outcome, array_to_string(list_filter([case when event_id % 5 = 0 then 'CF-Cache-Status=HIT' end, case when event_id % 7 = 0 and event_id % 3 > 0 then 'Age=' || event_id % 3 end,
        case when event_id % 11 = 0 then 'X-Cache=Stale from x' end, case when event_id % 13 = 0 then 'Warning=110 stale' end], lambda x: x is not null), ';') as reasons,
        case outcome when 'ok' then 'ok' when 'rate_limited' then 'rate_limited' when 'blocked_or_challenge' then 'blocked_or_challenge' when 'robots_disallowed' then 'blocked_or_challenge' when 'robots_unavailable' then 'network_error'
        when 'server_error' then 'server_error' when 'timeout' then 'timeout' when 'network_error' then 'network_error' else 'http_error' end as check_result from o""")
def q_fetch_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = captured(spark, sf_dir).withColumn("outcome", responses.page_outcome())
    reasons = responses.stale_reasons(F.col("cf"), F.col("age"), F.col("x_cache"), F.col("warning"))
    result = F.when(F.col("outcome") == "ok", "ok").otherwise(S.lookup(responses.OUTCOME_RESULTS, F.col("outcome"), F.lit("http_error")))
    return rows.select("event_id", "outcome", F.array_join(reasons, ";").alias("reasons"), result.alias("check_result"))


@query("""select event_id, case when event_id % 17 = 0 or s in (403, 429) then 'blocked' when s < 300 then case when event_id % 3 > 0 then 'redirected' else 'reachable' end when s >= 500 then 'server_error' else 'client_error' end as status,
    case event_id % 5 when 0 then 'tls_error' when 1 then 'dns_error' when 2 then 'tls_error' when 3 then 'dns_error' else 'client_error' end as transport
    from (select event_id, [200, 204, 304, 403, 404, 429, 500, 503][event_id % 8 + 1] as s from events)""")
def q_link_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    status = F.element_at(F.array(*map(F.lit, (200, 204, 304, 403, 404, 429, 500, 503))), (e % 8 + 1).cast("int"))
    kinds = F.when(e % 5 == 0, F.array(F.lit("ssl"))).when(e % 5 == 1, F.array(F.lit("gaierror"))).otherwise(F.array(F.lit("connect")))
    message = F.when(e % 5 == 2, "Certificate has expired").when(e % 5 == 3, "Name or service not known").otherwise("reset")
    rows = A.table(spark, sf_dir, "events").select("event_id", responses.link_status(status, e % 3, F.when(e % 17 == 0, "Challenge"), F.lit("")).alias("status"), responses.transport_status(kinds, message).alias("transport"))
    return rows


@query("""select n_nationkey as n, 'https://a' || n_nationkey || '.example/' as url,
    case when n_nationkey % 5 = 4 then 'https://a' || n_nationkey || '.example/p1' when n_nationkey % 5 = 3 then 'https://a' || n_nationkey || '.example/' else 'https://a' || n_nationkey || '.example/' || case n_nationkey % 5 when 0 then '' when 1 then 'p1' else 'p5' end end as final_url,
    cast(case n_nationkey % 5 when 0 then 0 when 1 then 1 when 2 then 5 when 3 then 0 else 1 end as integer) as redirect_count,
    case n_nationkey % 5 when 0 then 'reachable' when 1 then 'redirected' when 2 then 'client_error' when 3 then 'client_error' else 'client_error' end as status,
    case n_nationkey % 5 when 2 then 'redirect limit exceeded' when 3 then 'redirect response has no Location header' when 4 then 'redirect loop detected' end as error from nation""")
def q_redirect_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hop lists of five shapes: none, one, too many, without a target, a loop."""
    n = F.col("n_nationkey")
    hop = lambda status, location: F.struct(F.lit(status).alias("status_code"), F.lit(location).cast("string").alias("location"), F.lit(None).cast("string").alias("cf_mitigated"), F.lit("").alias("body_prefix"))
    shapes = [[hop(200, None)], [hop(302, "/p1"), hop(200, None)], [*[hop(301, f"/p{i}") for i in range(1, 7)], hop(200, None)], [hop(307, None)], [hop(308, "p1"), hop(301, "./")]]
    hops = F.array(*shapes[4])
    for i, shape in enumerate(shapes[:4]):
        hops = F.when(n % 5 == i, F.array(*shape)).otherwise(hops)
    url = F.concat(F.lit("https://a"), n.cast("string"), F.lit(".example/"))
    links = A.table(spark, sf_dir, "nation").select(url.alias("url"), hops.alias("hops"), n.alias("n"))
    walked = responses.walk_redirects(links).drop("http_status")
    return links.select("n", "url").join(walked, "url").select("n", "url", "final_url", "redirect_count", "status", "error")


POLICY = SchedulePolicy()
