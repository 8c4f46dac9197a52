"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is cut, greedily, into the longest
phrases that occur in a language's labelled text; the language that needs the fewest phrases, normalised by
the length of its labelled text (phrases * log2(length + alphabet) / symbols, the cross-parsing entropy), wins.
A phrase is one of so many places or symbols, so little labelled text does not make phrases cheap; a symbol
that a language lacks costs every language what it costs the one with the longest text.

Texts are lower-cased, runs of anything but letters become one space, and the symbols are the bytes of what is
left in UTF-8: every script has its own phrases, and the automata's tables stay narrow whatever letters there are.
Long texts are parsed whole, in segments of SEGMENT bytes: a cut costs each language the same phrase.

Edge cases: at most LANGUAGES labels are learned, the commonest; labelled rows without a letter teach nothing, so a language of such rows alone is none; null text or
text without a letter is `und` with score 0; ties go to the first language by name;
with no labelled text everything is `und`; repeated rows each get their own result; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftfold.llm.common import column, fold_of, once, slices, small_batches, texts_of

UNKNOWN = "und"
FOLDS = 5
#: Bounds of the labelled sample: documents a language, characters of each, characters in all languages together.
TRAIN_DOCS, TRAIN_DOC_CHARS, TRAIN_CHARS = 96, 2_000, 160_000
#: Most labels that are learned, the commonest, and the characters that each may have at the least.
LANGUAGES, LEAST_CHARS = 200, 2_000
SEGMENT, STREAMS = 2_048, 4_096
#: Code points below this have their class in a table; those above are asked one distinct one at a time.
TABLE = 0x3000


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(TABLE)])


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")


def is_letter(points: np.ndarray) -> np.ndarray:
    found = _letters()[np.minimum(points, TABLE - 1)]
    if (high := points >= TABLE).any():
        distinct, back = np.unique(points[high], return_inverse=True)
        found[high] = np.array([chr(c).isalpha() for c in distinct])[back]
    return found


def suffix_automaton(codes: list[int], width: int) -> np.ndarray:
    """Transitions of the automaton of all substrings, states x width, -1 where there is none."""
    nexts: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in codes:
        cur = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    moves = np.full((len(nexts), width), -1, dtype=np.int32)
    for state, out in enumerate(nexts):
        for c, to in out.items():
            moves[state, c] = to
    return moves


@dataclass(frozen=True)
class Languages:
    """Labelled text by language; small enough to send to every worker."""

    texts: tuple[tuple[str, str], ...]

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.texts]


class Parser:
    """The automata of all languages as one table of steps: twice the next state's row, odd where a phrase starts."""

    def __init__(self, languages: Languages):
        self.names = languages.names
        alphabet = np.unique(np.concatenate([self.normal(text)[0] for _, text in languages.texts] + [np.array([ord(" ")], np.uint8)]))
        self.width = len(alphabet) + 1
        # 0 stands for the bytes that no language has.
        self.code = np.zeros(256, dtype=np.int32)
        self.code[alphabet] = np.arange(1, self.width)
        tables, self.starts, self.bits, rows = [], [], [], 0
        self.lacks = np.ones((len(self.names), self.width), dtype=np.int64)
        for i, (_, text) in enumerate(languages.texts):
            codes = self.codes(self.normal(text)[0])
            self.lacks[i, codes] = 0
            moves = suffix_automaton(codes.tolist(), self.width)
            # One more state, between phrases: any character starts a phrase there, and one that occurs nowhere is a phrase and leads back.
            between = len(moves)
            moves = np.vstack((moves, np.full((1, self.width), -1, dtype=np.int32)))
            first = np.where(moves[0] >= 0, moves[0], between)
            rest = moves < 0
            tables.append(np.where(rest, (first[None, :] + rows) * (2 * self.width) + 1, (moves + rows) * (2 * self.width)))
            self.starts.append((rows + between) * 2 * self.width)
            self.bits.append(np.log2(len(codes) + self.width))
            rows += len(moves)
        self.steps = np.concatenate(tables).astype(np.int64 if rows * self.width >= 1 << 30 else np.int32).ravel() if tables else np.zeros(0, np.int32)

    @staticmethod
    def normal(text: str) -> tuple[np.ndarray, bool]:
        """UTF-8 bytes of the lower-case text with runs of anything but letters as one space; whether there is a letter."""
        points = code_points(text)
        letter = is_letter(points)
        kept = letter.copy()
        kept[1:] |= letter[:-1]
        cleaned = np.where(letter, points, np.uint32(ord(" ")))[kept]
        if not len(cleaned) or cleaned.max() < 0x80:
            return cleaned.astype(np.uint8), bool(letter.any())
        spelled = cleaned.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        return np.frombuffer(spelled, np.uint8), bool(letter.any())

    def codes(self, symbols: np.ndarray) -> np.ndarray:
        return self.code[symbols]

    def phrases(self, segments: list[np.ndarray]) -> np.ndarray:
        """Phrases of each segment, segments x languages."""
        order = np.argsort([-len(s) for s in segments], kind="stable")
        lengths = np.array([len(segments[i]) for i in order])
        matrix = np.zeros((lengths[0], len(segments)), dtype=np.int32)
        for at, i in enumerate(order):
            matrix[: lengths[at], at] = segments[i]
        state = np.repeat(np.array(self.starts, dtype=np.int64)[:, None], len(segments), axis=1)
        count = np.zeros((len(self.names), len(segments)), dtype=np.int32)
        active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
        for t in range(lengths[0]):
            n = active[t]
            step = self.steps[(state[:, :n] >> 1) + matrix[t, :n]]
            count[:, :n] += step & 1
            state[:, :n] = step
        out = np.empty((len(segments), len(self.names)), dtype=np.int64)
        out[order] = count.T
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float], list[float | None]]:
        """Language, score and cross-parsing entropy in bits a byte of each text."""
        names, scores, bits = [UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts)
        if not self.names:
            return names, scores, bits
        segments, owner, size = [], [], np.zeros(len(texts))
        total, lacking = np.zeros((len(texts), len(self.names))), np.zeros((len(texts), len(self.names)))

        def flush() -> None:
            if segments:
                np.add.at(total, owner, self.phrases(segments))
                segments.clear()
                owner.clear()

        for i, text in enumerate(texts):
            points, lettered = self.normal(text)
            if not lettered:
                continue
            codes = self.codes(points)
            size[i] = len(codes)
            lacking[i] = self.lacks @ np.bincount(codes, minlength=self.width)
            for at in range(0, len(codes), SEGMENT):
                segments.append(codes[at : at + SEGMENT])
                owner.append(i)
            if len(segments) >= STREAMS:
                flush()
        flush()
        bits_each = np.array(self.bits)
        # Each byte that a language lacks is a phrase of its own.
        entropy = (total * bits_each + lacking * (bits_each.max() - bits_each)) / np.maximum(size, 1)[:, None]
        for i in np.flatnonzero(size):
            best = int(np.argmin(entropy[i]))
            others = np.delete(entropy[i], best)
            names[i], bits[i] = self.names[best], float(entropy[i][best])
            scores[i] = float(np.clip(1 - entropy[i][best] / others.min(), 0, 1)) if len(others) and others.min() > 0 else 1.0
        return names, scores, bits


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Languages:
    """Languages from a bounded sample: per language the TRAIN_DOCS rows of smallest hash.

    A first pass counts rows per language, so that the second one only ranks about four times the wanted
    number of rows for each of the LANGUAGES commonest labels, however many there are.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64("doc_id", text).alias("h")).where("lang is not null and text is not null").where(F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    if not counts:
        return Languages(())
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 4 * TRAIN_DOCS / n))])
    gated = rows.where(F.pmod("h", F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * (1 << 30))
    ranked = gated.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))).where(F.col("nth") <= TRAIN_DOCS)
    found = ranked.select("lang", "nth", F.substring("text", 1, TRAIN_DOC_CHARS).alias("text")).orderBy("lang", "nth").collect()
    each = max(LEAST_CHARS, TRAIN_CHARS // len(counts))
    joined: dict[str, str] = {}
    for r in found:
        if len(joined.get(r["lang"], "")) < each:
            joined[r["lang"]] = joined.get(r["lang"], "") + r["text"] + "\n"
    return Languages(tuple((k, v[:each]) for k, v in sorted(joined.items()) if is_letter(code_points(v[:each])).any()))


def identify(docs: DataFrame, languages: Languages, text: str = "text") -> DataFrame:
    """docs with lang_pred, score and lang_bits (cross-parsing entropy in bits a byte, null for `und`)."""
    sent = small_batches(docs).sparkSession.sparkContext.broadcast(languages)
    key = uuid.uuid4().hex
    old = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score", "lang_bits")]
    docs = docs.select(*[F.col(f"`{f.name}`") for f in old])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            names, scores, bits = once(key, lambda: Parser(sent.value)).predict(texts_of(batch, text))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(bits, pa.float64())], names=[*batch.schema.names, "lang_pred", "score", "lang_bits"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in old), "lang_pred string, score double, lang_bits double"])
    return docs.mapInArrow(predict, schema)


def held_out_prediction(docs: DataFrame) -> DataFrame:
    """Every document's prediction, learned from the documents outside the held-out fold."""
    learned = train(docs.where(fold_of("doc_id", FOLDS) != 0))
    return identify(docs.select("doc_id", "text"), learned).select("doc_id", (fold_of("doc_id", FOLDS) == 0).alias("held_out"), "lang_pred", "score", "lang_bits")
