"""Personal data: patterns propose spans, validators confirm them, context words adjust the score.

Native: DataFrame functions only. A pattern's matches come from regexp_extract_all and the text between
them from split with the same pattern, so that running lengths give code point offsets. The context of a match
is read from the text between it and its neighbours, so a long text full of matches takes time in proportion to
its length; all repeated groups are possessive or bounded, so no match needs a deep stack.

A span counts if its score is LEAST or more. The contract's kinds reach that by their validators alone; a national
phone number, which has no checksum, needs a context word.

Edge cases: null and empty texts have no spans; a null doc_id is kept; repeated rows each get their own
result; extra input columns are kept unless their name is one of the result's, which then wins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The kinds in the order in which spans of equal start are listed; iban and national are this method's own.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national")

# Each pattern finds what the contract's pattern finds. `(?:\G|(?<!...))` starts a match only where a run
# begins or the last match ended: starts inside a run fail as its start does, and trying them all would be
# quadratic in the run. The card pattern takes the maximal runs of 14 to 19 digits, those that pass the count.
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "national": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![ .-]?[0-9]|[A-Za-z])",
}
#: A cheap test that a text must pass before its pattern is run.
GATES = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: F.rlike(t, F.lit(r"[0-9]\.[0-9]")),
    "card": lambda t: F.rlike(t, F.lit(r"[0-9](?:[ -]?[0-9]){13}")),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "iban": lambda t: F.rlike(t, F.lit(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11}")),
    "national": lambda t: F.rlike(t, F.lit(r"[0-9]{3}[ .-][0-9]{4}")),
}
#: Whole words near a span that raise its score, by kind.
CONTEXT = {
    "email": ("mail", "email", "e-mail", "contact", "write", "address"),
    "ip": ("ip", "host", "server", "addr", "address"),
    "card": ("card", "visa", "credit", "pay", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "transfer"),
    "national": ("phone", "call", "tel", "mobile", "fax"),
}
#: Score of a confirmed span, what a context word adds, how many code points on either side are read, and the score that counts.
CONFIRMED = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.5, "iban": 0.9, "national": 0.3}
CONTEXT_GAIN, CONTEXT_REACH, LEAST = {"national": 0.3}, 40, 0.5
USUAL_GAIN = 0.1
#: Matches a chunk of a running fold holds.
CHUNK = 128

SPAN = "struct<start:int,rank:int,kind:string,end:int,score:double>"


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    """Every second digit from the right doubled, nines cast out; the sum divides by ten."""
    rev = F.reverse(_digits(s))

    def term(i: Column) -> Column:
        digit = F.substring(rev, i, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 0, digit * 2).otherwise(digit)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(1), F.length(rev)), F.lit(0), lambda acc, i: acc + term(i))
    return total % 10 == 0


def _mod97(s: Column) -> Column:
    """The first four characters moved to the end, letters as two digits; the remainder by 97 is 1."""
    moved = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        code = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97).cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def _octets(s: Column) -> Column:
    return F.rlike(s, F.lit(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$"))


VALID = {
    "email": lambda s: F.lit(True),
    "ip": _octets,
    "card": _luhn,
    "phone": lambda s: F.length(_digits(s)).between(10, 15),
    "iban": _mod97,
    "national": lambda s: F.lit(True),
}


def _chunks(n: Column) -> Column:
    """Numbers of the chunks that n elements make."""
    return F.sequence(F.lit(0), F.floor((n - 1) / CHUNK).cast("int"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _spans(text: Column, kind: str) -> Column:
    """Array of SPAN: the kind's confirmed matches in the text that score LEAST or more, in order."""
    blank = F.array().cast(f"array<{SPAN}>")
    # A word of the list with no letter or digit beside it.
    words = rf"(?i)(?<![\p{{L}}\p{{N}}])(?:{'|'.join(CONTEXT[kind])})(?![\p{{L}}\p{{N}}])"

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(F.coalesce(x["hit"], F.lit("")))
        near = F.concat(F.right(x["gap"], F.lit(CONTEXT_REACH)), F.lit(" | "), F.left(F.coalesce(x["next"], F.lit("")), F.lit(CONTEXT_REACH)))
        gain = F.when(F.rlike(near, F.lit(words)), F.lit(CONTEXT_GAIN.get(kind, USUAL_GAIN))).otherwise(F.lit(0.0))
        score = F.lit(CONFIRMED[kind]) + gain
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), score.alias("score"))
        valid = F.coalesce(x["hit"].isNotNull() & VALID[kind](x["hit"]) & (score >= LEAST), F.lit(False))
        return F.struct(end.alias("at"), F.when(valid, F.array_append(acc["out"], span.cast(SPAN))).otherwise(acc["out"]).alias("out"))

    def folded(gaps: Column) -> Column:
        hits = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
        parts = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), F.slice(gaps, F.lit(2), F.size(gaps)).alias("next"))

        def over(parts: Column) -> Column:
            def chunk(acc: Column, i: Column) -> Column:
                done = F.aggregate(F.slice(parts, i * CHUNK + 1, F.lit(CHUNK)), F.struct(acc["at"].alias("at"), blank.alias("out")), step)
                return F.struct(done["at"].alias("at"), F.array_append(acc["outs"], done["out"]).alias("outs"))

            zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{SPAN}>>").alias("outs"))
            return F.aggregate(_chunks(F.size(parts)), zero, chunk, lambda acc: F.flatten(acc["outs"]))

        return _bound(parts, over)

    return F.when(GATES[kind](text), _bound(F.split(text, PATTERNS[kind], -1), folded)).otherwise(blank)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, text: str = "text", into: str = "pii_spans") -> DataFrame:
    """docs with a column of spans, an array of SPAN by start, then kind."""
    whole = F.coalesce(F.col(text), F.lit(""))
    gated = F.when(F.rlike(whole, F.lit("[@+]|[0-9]")), F.array_sort(F.concat(*[_spans(whole, kind) for kind in KINDS])))
    return docs.withColumn(into, F.coalesce(gated, F.array().cast(f"array<{SPAN}>")))


def _is(kind: str):
    return lambda s: s["kind"] == kind


def pii_digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts by base kind, digest of the base spans, all spans as text and their highest score."""
    found = find_pii(docs.select("doc_id", "text"))
    spans = F.col("pii_spans")
    base = F.filter(spans, lambda s: s["rank"] < len(BASE_KINDS))
    counts = [F.size(F.filter(spans, _is(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
        F.coalesce(F.array_max(F.transform(spans, lambda s: s["score"])), F.lit(0.0)).alias("top_score"),
    )


def mask_pii(docs: DataFrame, text: str = "text", least: float = LEAST) -> DataFrame:
    """docs with every span of that score or more replaced by its kind, as in <EMAIL>.

    Of overlapping spans the first one names the mask, and the mask covers them all. Texts without spans
    stay as they are, null included. A chunk of spans is cut out of the text once and masked by itself.
    """
    whole = F.col(text)

    def masked(kept: Column) -> Column:
        def chunk(acc: Column, i: Column) -> Column:
            spans = F.slice(kept, i * CHUNK + 1, F.lit(CHUNK))
            first = acc["at"]
            end = F.greatest(first, F.array_max(F.transform(spans, lambda s: s["end"])))

            def cut(piece: Column) -> Column:
                def step(inner: Column, s: Column) -> Column:
                    gap = F.substring(piece, inner["at"] - first + 1, s["start"] - inner["at"])
                    named = F.concat(inner["out"], gap, F.lit("<"), F.upper(s["kind"]), F.lit(">"))
                    return F.struct(F.greatest(inner["at"], s["end"]).alias("at"), F.when(s["start"] >= inner["at"], named).otherwise(inner["out"]).alias("out"))

                done = F.aggregate(spans, F.struct(first.alias("at"), F.lit("").alias("out")), step)
                return F.struct(done["at"].alias("at"), F.array_append(acc["outs"], done["out"]).alias("outs"))

            return _bound(F.substring(whole, first + 1, end - first), cut)

        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("outs"))
        return F.aggregate(_chunks(F.size(kept)), zero, chunk, lambda acc: F.concat(F.array_join(acc["outs"], ""), F.substring(whole, acc["at"] + 1, F.length(whole))))

    into = "pii_spans"
    while into in docs.columns:
        into += "_"
    kept = F.filter(F.col(into), lambda s: s["score"] >= least)
    found = find_pii(docs, text, into)
    return found.withColumn(text, F.when(F.size(kept) > 0, _bound(kept, masked)).otherwise(whole)).drop(into)
