"""Queries of the engine's edges: strict scans, documents, layouts, wire forms, retries, and rules of what comes in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftfold.functions import scalars as S
from driftfold.functions import web
from driftfold.operators import responses, safety, validate
from driftfold.plans import adapters as A
from driftfold.plans.catalogue import ISO, query
from driftfold.sources import layout, records, singletons


def turn(n: F.Column, *values: F.Column | str) -> F.Column:
    """The value whose place is n modulo their number."""
    return F.element_at(F.array(*[F.lit(v) if isinstance(v, str) else v for v in values]), (F.pmod(n, F.lit(len(values))) + 1).cast("int"))


SCAN_SQL = f"""with {A.USERS_SQL}, g as (select id, id % 13 as f, cast(id % 1000 * 2 + 1 as integer) as nth,
        lpad(cast(id // 1000 * 1000 as varchar), 5, '0') || '-' || lpad(cast(id // 1000 * 1000 + 999 as varchar), 5, '0') || '.jsonl' as home from users)"""


@query(f"""{SCAN_SQL}
    select home as file, nth, ['blank row', 'invalid JSON', 'row must be an object', 'row is not canonically encoded'][f + 1] as fault from g where f < 4
    union all select 'x-' || home, nth, 'row outside its file' from g where f = 4
    union all select distinct 'x-' || home, 0, 'foreign file name' from g where f = 4
    union all select home, nth + 1, unnest(['repeated key', 'out of order']) from g where f = 5
    union all select home, nth, 'row is not canonically encoded' from g where f = 6""")
def q_strict_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of user lines, one kind for each remainder of the id by 13: sound ones from 7 on."""
    rows = A.users(spark, sf_dir).select("id", "profile_status", F.col("last_checked_at").alias("seen_at"))
    columns = {"id": "bigint", "profile_status": "string", "seen_at": "timestamp_ntz"}
    line, f = F.to_json(F.struct(*columns), S.WIRE), F.col("id") % 13
    text = (
        F.when(f == 0, F.lit(" ")).when(f == 1, F.rtrim(line, F.lit("}"))).when(f == 2, F.concat(F.lit("["), line, F.lit("]")))
        .when(f == 3, F.replace(line, F.lit(":"), F.lit(": "))).when(f == 6, F.replace(line, F.lit("Z"), F.lit(".5Z"))).otherwise(line)
    )
    home = S.shard_name(F.col("id"))
    copies = F.explode(F.when(f == 5, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    each = rows.select(F.when(f == 4, F.concat(F.lit("x-"), home)).otherwise(home).alias("file"), (F.col("id") % 1000 * 2 + 1).cast("int").alias("at"), copies.alias("copy"), text.alias("line"))
    lines = each.select("file", (F.col("at") + F.col("copy")).alias("nth"), "line")
    return records.strict_rows(lines, columns, "id", file_pattern=records.USER_FILE, home=home)[1]


@query(f"""with {A.USERS_SQL} select id, case id % 7 when 2 then 'invalid JSON' when 3 then 'invalid JSON' when 4 then 'must be an object' when 5 then 'not canonically serialized' when 6 then 'not canonically serialized' end as fault,
    case when id % 7 < 2 then id end as next_id, case when id % 7 < 2 then strftime(last_checked_at, {ISO}) end as updated_at from users""")
def q_strict_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of seven shapes: in order, in free form, with a key given twice, cut off, in an array, with a text for a number, with a field too many."""
    at, n = S.iso(F.col("last_checked_at")), F.col("id").cast("string")
    plain = F.concat(F.lit('{"next_id":'), n, F.lit(',"updated_at":"'), at, F.lit('"}'))
    shapes = (
        plain, F.concat(F.lit('{ "updated_at" : "'), at, F.lit('",\n "next_id" : '), n, F.lit("}\n")), F.concat(F.lit('{"next_id":1,"next_id":'), n, F.lit("}")), F.rtrim(plain, F.lit("}")), F.concat(F.lit("["), plain, F.lit("]")),
        F.concat(F.lit('{"next_id":"'), n, F.lit('","updated_at":"'), at, F.lit('"}')), F.concat(F.lit('{"extra":1,'), F.substring(plain, 2, 1_000)),
    )
    texts = A.users(spark, sf_dir).select("id", turn(F.col("id"), *shapes).alias("text"))
    done = singletons.strict_documents(texts, {"next_id": "bigint", "updated_at": "timestamp_ntz"})
    return done.select("id", "fault", F.col("row.next_id").alias("next_id"), S.iso(F.col("row.updated_at")).alias("updated_at"))


@query(f"""with {A.USERS_SQL} select id, '{{' || chr(10) || '  "blog_url": ' || coalesce('"' || blog_url || '"', 'null') || ',' || chr(10) || '  "pair": {{' || chr(10) || '    "a : b": "x : y",' || chr(10) || '    "n": ' || id || chr(10) || '  }},' || chr(10)
    || '  "updated_at": "' || strftime(last_checked_at, {ISO}) || '"' || chr(10) || '}}' || chr(10) as text from users""")
def q_pretty_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = F.struct(F.lit("x : y").alias("a : b"), F.col("id").alias("n"))
    return A.users(spark, sf_dir).select("id", S.pretty_json(F.struct("blog_url", pair.alias("pair"), F.col("last_checked_at").alias("updated_at"))).alias("text"))


ENTRY_FOLDERS, ENTRY_KINDS = ("data", "state", "data/changes", "data/runs"), ("file", "directory", "link")
ENTRY_NAMES = (".gitkeep", "blogs.csv", "changes", "crawler.json", "2026.jsonl", "notes.txt", "users")


@query(f"""with e as (select l_orderkey % 4 as a, l_partkey % 7 as b, l_suppkey % 3 as c, l_linenumber % 2 as bytes from lineitem),
    n as (select distinct {list(ENTRY_FOLDERS)!r}[a + 1] as folder, {list(ENTRY_NAMES)!r}[b + 1] as name, {list(ENTRY_KINDS)!r}[c + 1] as kind, bytes from e),
    w as (select *, case when folder = 'data' then case when name in ('.gitkeep', 'blogs.csv') then 'file' when name in ('changes', 'users') then 'directory' end
        when folder = 'state' then case when name = 'crawler.json' then 'file' end else 'file' end as wanted from n)
    select folder, name, case when wanted is null then 'unexpected entry' when kind <> wanted then 'must be a ' || wanted else 'must be empty' end as fault from w
    where wanted is null or kind <> wanted or (name = '.gitkeep' and bytes > 0)""")
def q_layout_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of made-up entries, one for each mix of folder, name, kind and size that the line items have."""
    rows = A.table(spark, sf_dir, "lineitem")
    found = rows.select(
        turn(F.col("l_orderkey"), *ENTRY_FOLDERS).alias("folder"), turn(F.col("l_partkey"), *ENTRY_NAMES).alias("name"), turn(F.col("l_suppkey"), *ENTRY_KINDS).alias("kind"), (F.col("l_linenumber") % 2).cast("long").alias("bytes")
    ).distinct()
    return layout.faults(found)


@query("select doc_id, md5(text || case when doc_id % 4 = 3 then chr(65533) else '' end) as digest from documents")
def q_decode_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies as bytes: without a charset, in the one named, with an unknown one, and with a byte that the named one lacks."""
    text = F.col("text")
    plain = F.encode(text, "UTF-8")
    body = turn(F.col("doc_id"), plain, F.encode(text, "UTF-16BE"), plain, F.concat(plain, F.unhex(F.lit("FF"))))
    header = turn(F.col("doc_id"), "text/html", "text/html; Charset = 'utf-16-be'", "text/html; charset=none-such", "text/html; charset=\"us-ascii\"")
    return A.table(spark, sf_dir, "documents").select("doc_id", F.md5(web.decode_body(body, header)).alias("digest"))


@query(f"""with {A.USERS_SQL} select id, case when id > 9 then profile_url end as plain, case when id > 9 then profile_url || '?_icbi_fresh=t%2F' || id end as fresh,
    'update-' || strftime(last_checked_at, '%Y%m%dT%H%M%SZ') || '-' || substr(sha256(cast(id as varchar)), 1, 8) as run_id from users""")
def q_page_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    uid = F.col("id")
    known = F.when(uid > 9, uid).otherwise(F.lit(0).cast("long"))
    token = F.concat(F.lit("t/"), uid.cast("string"))
    return A.users(spark, sf_dir).select("id", S.page_url(A.SITE, known).alias("plain"), S.page_url(A.SITE, known, token).alias("fresh"), S.run_id("update", F.col("last_checked_at"), uid).alias("run_id"))


@query("""select event_id, case event_id % 3 when 0 then 'view' when 1 then event_type else null end as given, case when event_type in ('view', 'click') then event_type else 'other' end as kind from events""")
def q_alias_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A member under three names, of which the first that is not null counts; a closed set read without regard to case."""
    kind = F.col("event_type")
    quoted = F.concat(F.lit('"'), kind, F.lit('"}'))
    row = turn(F.col("event_id"), F.lit('{"state":null,"status":"view","old":"x"}'), F.concat(F.lit('{"old":'), quoted), F.lit('{"none":1}'))
    return A.table(spark, sf_dir, "events").select("event_id", S.first_given(row, "state", "status", "old").alias("given"), S.one_of(F.concat(F.lit(" "), F.initcap(kind)), ("view", "click"), "other").alias("kind"))


@query("""with e as (select event_id, event_id % 4 + 1 as a, case when event_id % 5 = 0 then cast(event_id % 200 as double) end as r, cast(event_id % 10 as double) / 10 as j from events)
    select event_id, case when a < 3 then case when r is not null then case when r <= 120 then r end else least(60.0, 3.0 * power(2.0, a - 1) * (0.8::double + j * 0.4::double)) end end as wait,
        cast(case when event_id % 3 = 0 or event_id % 7 = 0 then 1 else 2 end as bigint) as attempts from e""")
def q_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    answer = lambda n: F.struct((n % 3 != 0).alias("retryable"), F.when(n % 7 == 0, 20.0).when(n % 7 == 1, 5.0).alias("retry_after"))
    wait = S.retry_wait(e % 4 + 1, F.when(e % 5 == 0, (e % 200).cast("double")), (e % 10).cast("double") / 10)
    return A.table(spark, sf_dir, "events").select("event_id", wait.alias("wait"), S.attempts_made(F.array(answer(e), answer(e + 1), answer(e + 2))).alias("attempts"))


@query("""select n_nationkey as n, n_nationkey % 6 in (0, 2, 3) as allowed, case when n_nationkey % 6 = 0 then cast(n_nationkey as double) end as crawl_delay from nation""")
def q_robots_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Robots answers of six kinds: rules with a delay for all, a challenge, two that say there are none, and two refusals."""
    n = F.col("n_nationkey")
    rules = F.concat(F.lit("User-agent: *\nCrawl-delay: "), n.cast("string"), F.lit("\nDisallow: /private\n"))
    status = F.element_at(F.array(*map(F.lit, (200, 200, 404, 410, 403, 503))), (n % 6 + 1).cast("int"))
    answers = A.table(spark, sf_dir, "nation").select(n.alias("n"), status.alias("http_status"), F.when(n % 6 == 1, "<p>cf-chl-x</p>").otherwise(rules).alias("body"), F.lit(True).alias("exact_allowed"))
    return responses.robots_outcomes(answers, "some-agent").select("n", "allowed", "crawl_delay")


@query(f"""with {A.OBS_SQL}, g as (select *, seq % 11 as f, result = 'ok' as ok from obs)
    select user_id, 'observation_claim' as code from g where ok and (f = 0 or (p = 'public' and (f = 4 or (f = 2 and b = 'present'))) or (f = 6 and (p = 'hidden' or b = 'absent')))
    union all select user_id, 'observation_version' from g where f = 1
    union all select 0, 'observation_user' from g where f = 3
    union all select user_id, 'observation_value' from g where f = 5
    union all select user_id, 'observation_url' from g where f = 6""")
def q_observation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with seven kinds of faults, by their number modulo 11."""
    f = F.col("seq") % 11
    swap = lambda c, kind, value: F.when(f == kind, value).otherwise(F.col(c))
    url = F.when(f == 2, None).when(f == 6, "ftp://x.example/").otherwise(F.col("blog_url"))
    planted = {"profile_status": swap("profile_status", 0, F.lit("unknown")), "parser_version": swap("parser_version", 1, F.lit("bad version")), "blog_url": url, "user_id": swap("user_id", 3, F.lit(0).cast("long")), "blog_status": swap("blog_status", 4, F.lit("unknown")), "check_result": swap("check_result", 5, F.lit("odd"))}
    rows = A.observations(spark, sf_dir).withColumns(planted)
    return validate.validate_observations(rows).select("user_id", "code")


@query("""with g as (select o_orderkey as key, o_orderkey % 9 as f, o_orderstatus as s from orders)
    select 'e' || key as event_id, 'change_transition' as code from g where (f in (0, 1) and s in ('P', 'O')) or (f = 2 and s = 'O')
    union all select 'e' || key, 'change_same' from g where f = 1
    union all select 'e' || key, 'change_value' from g where f in (2, 3)
    union all select 'e' || key, 'change_kind' from g where f = 4
    union all select 'e' || key, 'change_user' from g where f = 5
    union all select 'e' || key, unnest(['change_value', 'change_same']) from g where f = 6""")
def q_change_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events with seven kinds of faults, by order key modulo 9: swapped sides, the same twice, no URL, no object, other kinds, no user, an odd profile."""
    f, kind = F.col("key") % 9, F.col("kind")
    blog = lambda n: S.canonical_json(status=F.lit("present"), url=F.concat(F.lit(f"https://{n}"), F.col("key").cast("string"), F.lit(".example/")))
    none = S.canonical_json(status=F.lit("absent"), url=F.lit(None).cast("string"))
    old, new = F.when(kind == "blog_added", none).otherwise(blog("a")), F.when(kind == "blog_removed", none).otherwise(blog("b"))
    planted = {
        "old_value": F.when(f == 0, new).when(f == 1, new).when(f == 6, '"odd"').otherwise(old),
        "new_value": F.when(f == 0, old).when(f == 2, '{"status":"present","url":null}').when(f == 3, '"present"').when(f == 6, '"odd"').otherwise(new),
        "kind": F.when(f == 4, "blog_moved").when(f == 6, "profile_status").otherwise(kind), "user_id": F.when(f == 5, F.lit(0).cast("long")).otherwise(F.col("user_id")),
    }
    return validate.validate_changes(A.changes(spark, sf_dir).withColumns(planted)).select(F.col("path").alias("event_id"), "code")


@query("""select cast(case when id + 1 >= 701 + 256 then 701 else id + 1 end as bigint) as maintenance_cursor from (select 701 + max(c_custkey) % 256 as id from customer)""")
def q_next_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    probes = A.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("seq"), (F.col("c_custkey") % 256 + 701).alias("id"))
    return safety.next_cursor(probes, 701, 256, 1)


@query("""with recursive r as materialized (select user_id, event_id as id, row_number() over (partition by user_id order by event_id) as rn, event_type in ('view', 'purchase') as e,
        case when event_id % 10 = 0 then 'unclear' when event_type in ('view', 'purchase') then 'existing' when event_type in ('click', 'error') then 'missing' else 'unclear' end as seen from events),
    w(user_id, rn, phase, next_id, start, missing, known, stop, last) as (
        select distinct user_id, 0::bigint, case when user_id % 2 = 0 then 'bootstrap' else 'boundary_confirmation' end, 1::bigint, case when user_id % 2 = 1 then 500::bigint end, 0::bigint, user_id % 3 = 0, null::varchar, null::bigint from r
        union all
        select user_id, rn, case when found then 'boundary_confirmation' when c and seen = 'existing' then 'bootstrap' when c and seen = 'missing' and over then 'maintenance' else phase end,
            case when found then id - 2 when c and seen = 'unclear' then start else id + 1 end, case when found then id - 2 when c and (seen = 'existing' or (seen = 'missing' and over)) then null else start end,
            case when not c then n when seen = 'existing' or (seen = 'missing' and over) then 0 else missing end, k,
            case when found then 'found' when c and seen = 'unclear' then 'unclear' when c and seen = 'missing' and over then 'confirmed' end, id
        from (select *, not c and n >= 3 as found from (select *, case when seen = 'missing' and k then missing + 1 else 0 end as n from (
            select w.*, r.id, r.seen, r.rn as rn1, w.phase = 'boundary_confirmation' as c, w.known or r.e as k, r.id >= w.start + 2 as over from w join r on r.user_id = w.user_id and r.rn = w.rn + 1 where w.stop is null)))
            t(user_id, rn0, phase, next_id, start, missing, known, stop, last, id, seen, rn, c, k, over, n, found))
    select user_id, phase, next_id, start, missing, known, stop, last from w qualify row_number() over (partition by user_id order by rn desc) = 1""")
def q_bootstrap_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bootstrap walks over each user's events, half of them while confirming a boundary of three ids."""
    uid, kind = F.col("user_id"), F.col("event_type")
    rows = A.table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("seq"), F.col("event_id").alias("id"), kind.isin("view", "purchase").alias("is_existing"), kind.isin("click", "error").alias("is_missing"), (F.col("event_id") % 10 != 0).alias("clean"))
    none, zero = F.lit(None), F.lit(0)
    start = F.struct(F.when(uid % 2 == 0, "bootstrap").otherwise("boundary_confirmation").alias("phase"), F.lit(1).alias("next_id"), F.when(uid % 2 == 1, 500).alias("start"), zero.alias("missing"), (uid % 3 == 0).alias("known"), none.alias("stop"), none.alias("last"))
    return safety.bootstrap_walk(rows, ["user_id"], start, run=3)
