"""URL, address, HTML and robots functions that have no native form, as pandas UDFs.

Their plain versions carry the rules and can be tested without Spark. Everything else stays native.
"""

from __future__ import annotations

import html
import ipaddress
import re
import unicodedata
from bisect import bisect, bisect_left
from collections import Counter
from contextlib import suppress
from html.parser import HTMLParser
from urllib.parse import quote, urljoin, urlsplit
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftfold.schema import URL_LENGTH

# Host endings that are not on the public Internet; escapes of control characters; a host label.
PRIVATE_ENDINGS = (".localhost", ".local", ".internal", ".home", ".lan")
ESCAPED_CONTROL = re.compile("%(?:0[0-9a-f]|1[0-9a-f]|7f)", re.IGNORECASE)
HOST_LABEL = re.compile("[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?", re.IGNORECASE)
# What a page shows in each state, after NFKC; the label of its link field and the text of an empty one.
MISSING_TEXT = "用户不存在!"
HIDDEN_TEXT = "此用户的个人主页未公开!"
FIELD_LABEL = re.compile(r"\s*博客\s*[：:]\s*")
EMPTY_FIELD = "暂无"
FIELD_TAGS = ("li", "dd", "tr", "p")
PLAIN_URL = re.compile(r"https?://\S+", re.IGNORECASE)
DEFAULT_PORT = {"http": 80, "https": 443}


#: What the ASCII name of a host on the public Internet meets, by rule.
HOST_RULES = {
    "length": lambda name: len(name) <= 253,
    "domain": lambda name: "." in name,
    "labels": lambda name: all(map(HOST_LABEL.fullmatch, name.split("."))),
    "top level": lambda name: not name.rpartition(".")[2].isdigit(),
    "reach": lambda name: not name.endswith(PRIVATE_ENDINGS),
}


def host_faults(name: str) -> list[str]:
    """The rules that a host's ASCII name breaks."""
    return [rule for rule, holds in HOST_RULES.items() if not holds(name)]


def _address(text: str) -> ipaddress.IPv4Address | ipaddress.IPv6Address | None:
    with suppress(ValueError):
        return ipaddress.ip_address(text)


def _public_host(host: str) -> str | None:
    """ASCII form of a host that is on the public Internet, else None."""
    plain = host.rstrip(".").lower()
    if (address := _address(plain)) is not None:
        return address.compressed if address.is_global else None
    with suppress(UnicodeError):
        name = plain.encode("idna").decode("ascii").lower()
        return None if host_faults(name) else name


def _assembled(scheme: str, host: str, port: int | None, path: str, query: str, fragment: str) -> str:
    shown = f"[{host}]" if ":" in host else host
    if port not in (None, DEFAULT_PORT[scheme]):
        shown += f":{port}"
    return f"{scheme}://{shown}{path or '/'}" + (f"?{query}" if query else "") + (f"#{fragment}" if fragment else "")


def published_url(value: str | None) -> str | None:
    """Canonical URL fit to publish, or None: entities and NFKC resolved, ASCII public host, no credentials, blanks or control characters."""
    if value is None:
        return None
    text = unicodedata.normalize("NFKC", html.unescape(value)).strip()
    if not text or len(text) > URL_LENGTH or "\\" in text or ESCAPED_CONTROL.search(text):
        return None
    if any(c.isspace() or unicodedata.category(c)[0] == "C" for c in text):
        return None
    try:
        parts = urlsplit(text)
        scheme, host, port = parts.scheme.lower(), parts.hostname, parts.port
    except ValueError:
        return None
    if scheme not in DEFAULT_PORT or not host or port == 0 or parts.username is not None or parts.password is not None:
        return None
    name = _public_host(host)
    return _assembled(scheme, name, port, parts.path, parts.query, parts.fragment) if name else None


def checked_url(value: str | None) -> str | None:
    """Canonical URL for a link check, or None: fragment dropped, no zone ids, credentials or control characters."""
    text = (value or "").strip()
    if not text or any(ord(c) < 32 or ord(c) == 127 for c in text):
        return None
    try:
        parts = urlsplit(text)
        scheme, host, port = parts.scheme.lower(), parts.hostname, parts.port
        host = (host or "").encode("idna").decode("ascii").lower().rstrip(".")
    except ValueError:
        return None
    if scheme not in DEFAULT_PORT or not host or "%" in host or "\\" in parts.netloc or "@" in parts.netloc:
        return None
    try:
        host = ipaddress.ip_address(host).compressed
    except ValueError:
        pass
    return _assembled(scheme, host, port or None, parts.path, parts.query, "")


def forbidden_address(value: str | None) -> bool:
    """Whether an address must not be connected to; text that is no address counts as one that must not."""
    try:
        address = ipaddress.ip_address((value or "").strip())
    except ValueError:
        return True
    mapped = getattr(address, "ipv4_mapped", None)
    if mapped is not None and forbidden_address(str(mapped)):
        return True
    return address.is_multicast or address.is_reserved or not address.is_global


def destination(url: str | None) -> str | None:
    """Link target for Markdown: what could end it is percent-encoded, escapes stay; None for a line break."""
    return None if url is None or "\r" in url or "\n" in url else quote(url, safe=":/?#@!$&'*+,;=%~._-")


def resolved(base: str | None, location: str | None) -> str | None:
    """Canonical target of a redirect, or None if it is unsafe."""
    try:
        return None if location is None else checked_url(urljoin(base or "", location))
    except ValueError:
        return None


def visible(text: str) -> str:
    return " ".join(unicodedata.normalize("NFKC", text).split())


class _Page(HTMLParser):
    """The elements as written, in one pass and without recursion: an end tag closes the nearest open element of its name, or nothing.

    strings: all visible text, stripped, in order. Element i covers strings first[i] to last[i] and holds the elements
    from i + 1 to end[i].
    """

    VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
    SILENT = ("script", "style", "template")

    def __init__(self, page: str) -> None:
        super().__init__(convert_charrefs=True)
        self.strings: list[str] = []
        self.tags, self.first, self.last, self.end = [], [], [], []
        self.hrefs: dict[int, str] = {}
        self.open: list[int] = []
        self.open_tags: Counter[str] = Counter()
        self.feed(page)
        self.close()
        while self.open:
            self._shut()

    def _shut(self) -> str:
        i = self.open.pop()
        self.last[i], self.end[i] = len(self.strings), len(self.tags)
        self.open_tags[self.tags[i]] -= 1
        return self.tags[i]

    def handle_starttag(self, tag, attrs):
        href = next((value or "" for name, value in attrs if name == "href"), None)
        if href is not None:
            self.hrefs[len(self.tags)] = href
        self.open.append(len(self.tags))
        self.open_tags[tag] += 1
        self.tags.append(tag)
        self.first.append(len(self.strings))
        self.last.append(0)
        self.end.append(0)
        if tag in self.VOID:
            self._shut()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in self.VOID:
            self._shut()

    def handle_endtag(self, tag):
        if self.open_tags[tag]:
            while self._shut() != tag:
                pass

    def handle_data(self, data):
        inside = self.tags[self.open[-1]] if self.open else ""
        if inside not in self.SILENT and (text := data.strip()):
            self.strings.append(text)

    def text(self, i: int) -> str:
        return " ".join(self.strings[self.first[i] : self.last[i]])

    def among(self, places: list[int], i: int) -> list[int]:
        """Those of the sorted places that lie in element i."""
        return places[bisect(places, i) : bisect_left(places, self.end[i])]


#: Strings that may make up a label, and distinct fields after which a page is ambiguous whatever else it holds.
LABEL_STRINGS, FIELDS = 3, 3


def link_facts(page: _Page, link: int, names: list[int]) -> dict:
    """What a field's only link shows and where it leads: `target` only if the shown text, with its scheme added, leads there too."""
    href = page.hrefs[link].strip()
    marked = page.among(names, link)
    raw = (page.text(marked[0]) if marked else "") or page.text(link) or href
    target, agrees = published_url(href), False
    # Shown text that no URL can be made of agrees with nothing.
    with suppress(ValueError):
        bare = target is not None and not urlsplit(raw.strip()).scheme
        shown = f"{urlsplit(target).scheme}://{raw.strip()}" if bare else raw
        agrees = target is not None and published_url(shown) == target
    return {"raw": raw, "target": target if agrees else None}


def field_facts(page: _Page) -> list[dict]:
    """Distinct labelled fields (links, raw, target, rest, plain), FIELDS at most; what they mean is decided elsewhere.

    links: how many the field has. raw and target are those of its only link. Without links: rest is the text after
    the label, and plain its canonical URL if it is one.
    """
    links = [i for i in sorted(page.hrefs) if page.tags[i] == "a"]
    names = [i for i, tag in enumerate(page.tags) if tag == "bdi"]
    labelled: dict[tuple, bool] = {}
    found: dict[tuple, dict] = {}
    for i, tag in enumerate(page.tags):
        if tag not in FIELD_TAGS:
            continue
        # Nested elements start with the same strings: these are looked at once.
        head = (page.first[i], min(page.last[i], page.first[i] + LABEL_STRINGS))
        if head not in labelled:
            labelled[head] = bool(FIELD_LABEL.match(visible(" ".join(page.strings[slice(*head)]))))
        if not labelled[head]:
            continue
        own = page.among(links, i)
        facts = {"links": len(own), "raw": None, "target": None, "rest": None, "plain": None}
        if len(own) == 1:
            facts |= link_facts(page, own[0], names)
        elif own:
            facts["links"] = 2
        else:
            facts["rest"] = FIELD_LABEL.sub("", visible(page.text(i)), count=1).strip()
            facts["plain"] = published_url(facts["rest"]) if PLAIN_URL.fullmatch(facts["rest"]) else None
        found[tuple(facts.values())] = facts
        if len(found) == FIELDS:
            break
    return list(found.values())


def page_facts(page: str | None) -> dict:
    """What classification needs of a page: its labelled fields, whether a state marker shows, title and text."""
    parsed = _Page(page or "")
    texts = [visible(s) for s in parsed.strings]
    title = visible(parsed.text(parsed.tags.index("title"))).lower() if "title" in parsed.tags else ""
    return {"fields": field_facts(parsed), "missing": MISSING_TEXT in texts, "hidden": HIDDEN_TEXT in texts, "title": title, "text": " ".join(texts)}


_FIELD = T.StructType([T.StructField("links", T.IntegerType()), *[T.StructField(name, T.StringType()) for name in ("raw", "target", "rest", "plain")]])
FACTS = T.StructType(
    [
        T.StructField("fields", T.ArrayType(_FIELD)),
        T.StructField("missing", T.BooleanType()),
        T.StructField("hidden", T.BooleanType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def robots_allow(rules: str | None, agent: str, url: str | None) -> bool:
    """Whether robots rules let the agent read exactly this URL."""
    parser = RobotFileParser()
    parser.parse((rules or "").splitlines())
    return parser.can_fetch(agent, url or "")


CHARSET = re.compile(r"charset\s*=\s*[\"']?([^;\s\"']+)", re.IGNORECASE)


def decoded(body: bytes, content_type: str | None) -> str:
    """A body in the charset that its header names; UTF-8 with replacements where that is unknown or does not fit."""
    named = CHARSET.search(content_type or "")
    if named:
        with suppress(LookupError, ValueError):
            return body.decode(named.group(1))
    return body.decode("utf-8", "replace")


def crawl_delay(rules: str | None, agent: str) -> float | None:
    """Seconds that robots rules ask the agent, or else everybody, to wait between requests."""
    parser = RobotFileParser()
    parser.parse((rules or "").splitlines())
    # Without a date of reading the parser answers nothing.
    parser.modified()
    asked = [d for d in (parser.crawl_delay(agent), parser.crawl_delay("*")) if d is not None]
    return max(0.0, float(asked[0])) if asked else None


@F.pandas_udf(T.StringType())
def decode_body(bodies: pd.Series, types: pd.Series) -> pd.Series:
    return pd.Series([None if b is None else decoded(b, t) for b, t in zip(bodies, types, strict=True)], dtype=object)


@F.pandas_udf(T.DoubleType())
def robots_delay(rules: pd.Series, agents: pd.Series) -> pd.Series:
    return pd.Series([crawl_delay(*x) for x in zip(rules, agents, strict=True)], dtype="float64")


@F.pandas_udf(T.StringType())
def publish_url(values: pd.Series) -> pd.Series:
    return values.map(published_url, na_action="ignore")


@F.pandas_udf(T.StringType())
def check_url(values: pd.Series) -> pd.Series:
    return values.map(checked_url, na_action="ignore")


@F.pandas_udf(T.BooleanType())
def is_forbidden(values: pd.Series) -> pd.Series:
    return values.map(forbidden_address)


@F.pandas_udf(T.StringType())
def link_destination(values: pd.Series) -> pd.Series:
    return values.map(destination, na_action="ignore")


def resolved_chain(base: str | None, locations: list[str | None]) -> list[str | None]:
    """Each redirect's target, seen from the last safe one."""
    out = []
    for location in locations:
        target = resolved(base, location)
        out.append(target)
        base = target or base
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def resolve_chain(bases: pd.Series, locations: pd.Series) -> pd.Series:
    return pd.Series([resolved_chain(b, list(x) if x is not None else []) for b, x in zip(bases, locations, strict=True)], dtype=object)


@F.pandas_udf(FACTS)
def read_page(pages: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([page_facts(p) for p in pages], columns=["fields", "missing", "hidden", "title", "text"])


@F.pandas_udf(T.BooleanType())
def may_read(rules: pd.Series, agents: pd.Series, urls: pd.Series) -> pd.Series:
    return pd.Series([robots_allow(*x) for x in zip(rules, agents, urls, strict=True)])
