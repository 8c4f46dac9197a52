"""Scalar functions and web functions against tables of literals."""

import json

import pytest
from pyspark.sql import functions as F

from driftfold.functions import scalars as S
from driftfold.functions import web
from driftfold.operators import responses


def one(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0].x


@pytest.mark.parametrize(
    ("url", "want"),
    [
        (" HTTPS://Example.COM:443/ ", "https://example.com/"),
        ("http://Example.COM:80/a?q=1#part", "http://example.com/a?q=1#part"),
        ("http://example.com.", "http://example.com/"),
        ("https://example.com:8443", "https://example.com:8443/"),
        ("http://[::1]:80/x", "http://[::1]/x"),
        ("ftp://example.com/", None),
        ("http://u:p@example.com/", None),
        ("http:///x", None),
        ("http://example.com:99999/", None),
        ("no url", None),
        (None, None),
    ],
)
def test_normalize_url(spark, url, want):
    assert one(spark, S.normalize_url(F.lit(url).cast("string"))) == want


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("https://Bücher.example/ü", "https://xn--bcher-kva.example/ü"),
        ("https://example.com/?a=1&amp;b=2", "https://example.com/?a=1&b=2"),
        ("https://example.com:443#x", "https://example.com/#x"),
        ("javascript:alert(1)", None),
        ("https://user@example.com/", None),
        ("http://127.0.0.1/", None),
        ("http://[::1]/", None),
        ("http://localhost/", None),
        ("http://a.internal/", None),
        ("https://example.com/%0a", None),
        ("https://exa mple.com/", None),
        ("https://example.com\\x", None),
        ("https://example.com:0/", None),
        ("https://single/", None),
        ("http://8.8.8.8/", "http://8.8.8.8/"),
        (None, None),
    ],
)
def test_published_url(url, want):
    assert web.published_url(url) == want


@pytest.mark.parametrize("address", ["127.0.0.1", "10.0.0.1", "192.168.1.1", "169.254.0.1", "0.0.0.0", "224.0.0.1", "100.64.0.1", "::1", "fc00::1", "fe80::1", "::", "::ffff:10.0.0.1", "ff02::1", "no address", None])
def test_forbidden_addresses(address):
    assert web.forbidden_address(address)


def test_public_addresses_and_checked_urls():
    assert not web.forbidden_address("8.8.8.8") and not web.forbidden_address("2606:4700::1111")
    assert web.checked_url("https://example.com/a#frag") == "https://example.com/a"
    assert web.checked_url("http://[fe80::1%25eth0]/") is None
    assert web.resolved("https://a.example/x/", "../y#z") == "https://a.example/y"
    assert web.resolved("https://a.example/", "ftp://b.example/") is None


def test_host_rules():
    assert web.host_faults("a.example") == []
    assert web.host_faults("localhost") == ["domain"]
    assert web.host_faults("a.local") == ["reach"]
    assert web.host_faults("a.1") == ["top level"]
    assert web.host_faults("-a.example") == ["labels"]
    assert "length" in web.host_faults(".".join(["a" * 60] * 5))


LINK = '<li>博客：<a href="https://blog.example/">{}</a></li>'


@pytest.mark.parametrize(
    ("page", "profile", "blog", "url", "result"),
    [
        (f"<p>{web.MISSING_TEXT}</p>", "missing", "unknown", None, "ok"),
        ("<div>此用户的个人主页未公开！</div>", "hidden", "unknown", None, "ok"),
        ("<ul><li>博客: 暂无</li></ul>", "public", "absent", None, "ok"),
        (LINK.format("<bdi>blog.example</bdi>"), "public", "present", "https://blog.example/", "ok"),
        (LINK.format("https://blog.example"), "public", "present", "https://blog.example/", "ok"),
        ("<p>博客：https://plain.example/x</p>", "public", "present", "https://plain.example/x", "ok"),
        (LINK.format("other.example"), "unknown", "unknown", None, "parse_error"),
        (LINK.format("blog.example") + "<li>博客: 暂无</li>", "unknown", "unknown", None, "parse_error"),
        ("<li>博客：<a href='https://a.example/'>a</a><a href='https://b.example/'>b</a></li>", "unknown", "unknown", None, "parse_error"),
        ("<title>Just a moment...</title>", "unknown", "unknown", None, "parse_error"),
        ("<p>verify you are human</p><script>captcha</script>", "unknown", "unknown", None, "parse_error"),
        (f"<p>{web.MISSING_TEXT}</p><li>博客: 暂无</li>", "public", "absent", None, "ok"),
        ("nothing here", "unknown", "unknown", None, "parse_error"),
        ("<li>博客：<span>暂无</li>" + LINK.format("blog.example") + "<p>博客：</p>", "unknown", "unknown", None, "parse_error"),
        ("<b>" * 5_000 + "<li><i>博客</i><i>：</i><i>暂无" + "</u>" * 5_000, "public", "absent", None, "ok"),
        ("<p>" * 20_000 + "博客：https://deep.example/", "public", "present", "https://deep.example/", "ok"),
        ("<p>博客：" * 20_000, "unknown", "unknown", None, "parse_error"),
        (LINK.format("blog.example 博客："), "unknown", "unknown", None, "parse_error"),
        ("<li>博客：<a href='http://[a'>http://[a</a></li>", "unknown", "unknown", None, "parse_error"),
        (LINK.format("") + LINK.format("https://blog.example/"), "public", "present", "https://blog.example/", "ok"),
        ("", "unknown", "unknown", None, "parse_error"),
        (None, "unknown", "unknown", None, "parse_error"),
    ],
)
def test_page_classification(spark, page, profile, blog, url, result):
    row = responses.classify_pages(spark.createDataFrame([(1, page)], "id long, body string")).collect()[0]
    assert (row.profile_status, row.blog_status, row.blog_url, row.check_result) == (profile, blog, url, result)


def test_text_functions(spark):
    assert one(spark, S.sanitize_error(F.lit(" a\t\nb c\x1cd "))) == "a b c d"
    assert one(spark, S.sanitize_error(F.lit(" \n "))) is None
    assert len(one(spark, S.sanitize_error(F.lit("x" * 600)))) == 500
    assert one(spark, S.markdown_escape(F.lit("a|b[c]*d_`<e>\\\r\n"))) == "a\\|b\\[c\\]\\*d\\_\\`\\<e\\>\\\\ <br>"
    assert one(spark, S.blog_label(F.lit("https://a.example/x/y//?q"))) == "a.example/x/y"
    assert one(spark, S.short_date(F.lit(None).cast("string"))) == "—"
    assert [one(spark, S.shard_name(F.lit(i).cast("long"))) for i in (1, 999, 1000, 123456)] == ["00000-00999.jsonl", "00000-00999.jsonl", "01000-01999.jsonl", "123000-123999.jsonl"]
    assert web.destination("https://a.example/(x) y%20é") == "https://a.example/%28x%29%20y%20%C3%A9" and web.destination("a\nb") is None


def test_canonical_json(spark):
    row = {"b": 'q"\\\n\x01\x7fé ', "a": None, "n": 3}
    got = one(spark, S.canonical_json(b=F.lit(row["b"]), a=F.lit(None).cast("string"), n=F.lit(3)))
    assert got == json.dumps(row, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


@pytest.mark.parametrize(("value", "digits", "want"), [("120", False, 120.0), ("-3", False, 0.0), ("1.5", False, 1.5), ("1.5", True, None), ("Sun, 01 Mar 2026 00:01:00 GMT", True, 60.0), ("Sat, 28 Feb 2026 00:00:00 GMT", False, 0.0), ("soon", False, None), (None, False, None)])
def test_retry_after(spark, value, digits, want):
    assert one(spark, S.retry_after_seconds(F.lit(value).cast("string"), F.lit("2026-03-01 00:00:00").cast("timestamp_ntz"), digits)) == want


def test_parse_iso(spark):
    assert one(spark, S.iso(S.parse_iso(F.lit("2026-03-01T01:02:03.9Z")))) == "2026-03-01T01:02:03Z"
    assert one(spark, S.parse_iso(F.lit("2026-03-01T01:02:03+01:00"))) is None


def test_robots_and_staleness(spark):
    rules = "User-agent: *\nDisallow: /private\n"
    assert web.robots_allow(rules, "x", "https://s.example/user/1") and not web.robots_allow(rules, "x", "https://s.example/private?x")
    reasons = responses.stale_reasons(F.lit("hit"), F.lit("5"), F.lit("Cache HIT"), F.lit('112 - "x", 110 - "y"'))
    assert one(spark, reasons) == ["CF-Cache-Status=HIT", "Age=5", "X-Cache=Cache HIT", 'Warning=112 - "x", 110 - "y"']
    robots = spark.createDataFrame([(200, rules)], "http_status int, body string")
    asked = spark.createDataFrame([("https://s.example/user/1",), ("https://s.example/private/1",)], "requested_url string")
    assert sorted((r.requested_url[-9:], r.exact_allowed) for r in responses.with_robots(asked, robots, "x").collect()) == [("le/user/1", True), ("private/1", False)]
