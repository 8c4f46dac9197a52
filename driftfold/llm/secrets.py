"""Secret scans: fixed patterns, and Markov models of random strings against ordinary identifiers.

Two character-trigram models are trained from labelled samples: random strings drawn from the alphabets that
keys use, and ordinary identifiers: words of a bounded sample of documents, outside the spans of the fixed patterns
and too short to be keys, and names, paths, dates, versions and ranges composed of them. Any run of 16 characters
or more that no pattern covers is a secret where random explains it better by MARGIN nats a character.

Edge cases: null and empty texts have no spans; a null doc_id is kept; repeated rows each get their own
result; with no training words identifiers are composed of NAME_WORDS; extra columns are left out.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftfold.llm.common import column, hash_sample, slices, small_batches, texts_of

#: The base kinds in the order in which spans of equal start are listed; markov is this method's own.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "markov")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
# Runs of that many characters or more are the runs that pass the length test.
ACCESS = re.compile("AKIA[A-Z0-9]{16,}")
HEX = re.compile("(?<![0-9a-f])[0-9a-f]{24,}")
TOKEN = re.compile("[A-Za-z0-9+/_-]{16,}={0,2}")
WORD = re.compile("[A-Za-z0-9]+")

#: Bounds of the labelled samples: documents read, words kept, identifiers composed, random strings drawn, letters of a word.
SAMPLE_DOCS, SAMPLE_WORDS, SAMPLE_NAMES, SAMPLE_RANDOM, WORD_CHARS = 400, 20_000, 20_000, 20_000, 15
#: Words that names are made of, beside those of the documents.
NAME_WORDS = (
    "account action active address admin after agent alert amount answer archive array asset author backup balance basic batch before block body branch buffer build bundle button cache call change channel chapter check child class client close cluster code collect color column "
    "command common compare component config connect const content context control copy count country create current custom daily data debug delete detail device direct display document domain driver dynamic early edit element email empty enable engine error event example execute export extra "
    "factory failed feature field figure file filter final first flag folder format forward frame function general global group guide hash header height hidden history house image import index initial input insert install internal item journal keyboard label language large layer layout learn length level "
    "library light limit line list local login long lookup machine main market master member memory message method minute mode model module month name network note number object option output package page path pattern"
).split()
#: How much better, in nats a character, random must explain a token than ordinary text does.
MARGIN = 1.3
#: Characters that the models know; the last one stands for the start of a token.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-^"
CODE = np.zeros(256, dtype=np.int64)
CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
START = len(ALPHABET) - 1


def _trigrams(token: str) -> np.ndarray:
    codes = np.concatenate(([START, START], CODE[np.frombuffer(token.encode("latin-1", "replace"), dtype=np.uint8)]))
    size = len(ALPHABET)
    return (codes[:-2] * size + codes[1:-1]) * size + codes[2:]


@dataclass(frozen=True)
class MarkovPair:
    """log P(random) - log P(identifier) of every trigram, as one flat table."""

    ratio: np.ndarray

    @staticmethod
    def train(secrets: list[str], ordinary: list[str]) -> MarkovPair:
        return MarkovPair((_log_model(secrets) - _log_model(ordinary)).ravel())

    def score(self, token: str) -> float:
        """Log-likelihood ratio in nats a character."""
        return float(self.ratio[_trigrams(token)].mean())


def _log_model(samples: list[str]) -> np.ndarray:
    """log P(c | a, b), each order smoothed by the one below, the lowest by a uniform one."""
    n = len(ALPHABET)
    counts = np.zeros(n**3)
    if samples:
        found, times = np.unique(np.concatenate([_trigrams(s) for s in samples]), return_counts=True)
        counts[found] = times
    three = counts.reshape(n, n, n)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p = (one + 1) / (one.sum() + n)
    p = (two + 8 * p) / (two.sum(axis=1, keepdims=True) + 8)
    return np.log((three + 8 * p) / (three.sum(axis=2, keepdims=True) + 8))


def random_samples(n: int = SAMPLE_RANDOM, seed: int = 7) -> list[str]:
    """Random strings of 16 to 48 characters over the alphabets of hex, base32, base62 and base64."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    alphabets = ["0123456789abcdef", letters.upper() + "234567", letters + "0123456789", letters + letters.upper() + "0123456789", letters + letters.upper() + "0123456789+/_-"]
    return ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(16, 48))) for _ in range(n)]


def composed(words: list[str], n: int = SAMPLE_NAMES, seed: int = 11) -> list[str]:
    """Identifiers as people write them: words joined in any of the usual ways, with numbers, dates, versions and ranges."""
    rng = random.Random(seed)
    words = words or NAME_WORDS

    def word() -> str:
        return rng.choice(rng.choice((words, NAME_WORDS))).lower()

    def number() -> str:
        kind = rng.randrange(6)
        if kind == 0:
            return f"{rng.randint(1970, 2039)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"
        if kind == 1:
            return f"{rng.randint(1970, 2039)}{rng.randint(1, 12):02}{rng.randint(1, 28):02}"
        if kind == 2:
            return f"v{rng.randint(0, 20)}_{rng.randint(0, 99)}"
        if kind == 3:
            return "-".join("0123456789"[: rng.randint(3, 10)] for _ in range(rng.randint(2, 3)))
        if kind == 4:
            return str(rng.randint(0, 10 ** rng.randint(1, 18)))
        return f"{(start := rng.randint(0, 99_999))}-{start + rng.randint(1, 999)}"

    out = []
    for _ in range(n):
        if rng.randrange(10) == 0:
            # A rule of one character, or characters in their order.
            start = rng.randrange(START)
            out.append(ALPHABET[start] * rng.randint(3, 40) if rng.randrange(2) else ALPHABET[start : start + rng.randint(3, 26)])
            continue
        parts = [word() for _ in range(rng.randint(2, 5))]
        style = rng.randrange(7)
        if style == 0:
            name = parts[0] + "".join(p.capitalize() for p in parts[1:])
        elif style == 1:
            name = "".join(p.capitalize() for p in parts)
        elif style == 2:
            name = "_".join(parts).upper()
        else:
            name = ("_", "-", "/", "")[style - 3].join(parts)
        place = rng.randrange(4)
        joint = rng.choice(("_", "-", "/", ""))
        out.append(name if place == 0 else number() + joint + name if place == 1 else name + joint + number() if place == 2 else number() + joint + number())
    return out


def identifier_samples(docs: DataFrame, limit: int = SAMPLE_DOCS) -> list[str]:
    """Words of a sample of documents, those of the smallest id hashes, at most 20,000 characters of each, and names composed of them."""
    rows = hash_sample(docs.where("text is not null").select("doc_id", F.substring("text", 1, 20_000).alias("text")), "doc_id", limit).collect()
    words: dict[str, None] = {}
    for row in rows:
        left, at = [], 0
        for start, end, _ in sorted(_base_spans(row["text"])):
            left.append(row["text"][at:start])
            at = max(at, end)
        for word in WORD.findall(" ".join([*left, row["text"][at:]])):
            if len(word) <= WORD_CHARS and len(words) < SAMPLE_WORDS:
                words.setdefault(word)
    letters = [w for w in words if w.isalpha()]
    return [*words, *composed(letters)]


def _base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, rank of the kind) of the fixed patterns' matches."""
    spans, small = [], text.lower()
    if any(w in small for w in ASSIGN_WORDS):
        spans += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    return spans + [(m.start(), m.end(), 2) for m in HEX.finditer(text)]


def find_secrets(text: str, models: MarkovPair | None) -> list[tuple[int, int, str]]:
    """(start, rank of the kind, kind:start:end) of all spans, in order."""
    spans = _base_spans(text)
    if models:
        spans += [(start, end, 3) for start, end in _markov(text, models, sorted(spans))]
    return [(s, k, f"{KINDS[k]}:{s}:{e}") for s, e, k in sorted(spans, key=lambda x: (x[0], x[2]))]


def _markov(text: str, models: MarkovPair, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Tokens beside the spans taken, which come in order, that random explains better."""
    at, last = 0, 0
    for m in TOKEN.finditer(text):
        while at < len(taken) and taken[at][0] < m.end():
            last = max(last, taken[at][1])
            at += 1
        if last <= m.start() and models.score(m[0]) > MARGIN:
            yield m.start(), m.end()


def scan_secrets(docs: DataFrame, models: MarkovPair) -> DataFrame:
    """doc_id, counts by kind, digest of the base spans and all spans as text."""
    models_of = small_batches(docs).sparkSession.sparkContext.broadcast(models)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [find_secrets(text, models_of.value) for text in texts_of(batch)]
            counts = [pa.array([sum(k == kind for _, k, _ in spans) for spans in found], pa.int64()) for kind in range(len(KINDS))]
            base = [",".join(s for _, k, s in spans if k < len(BASE_KINDS)) for spans in found]
            digest = pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base], pa.string())
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), *counts, digest, pa.array([",".join(s for *_, s in spans) for spans in found], pa.string())], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def trained_models(docs: DataFrame) -> MarkovPair:
    return MarkovPair.train(random_samples(), identifier_samples(docs))
