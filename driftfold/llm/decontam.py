"""Benchmark decontamination: BM25 over an inverted index of test items, searched with block-max WAND.

Items are indexed in classes of similar length. A document is cut into passages of SPAN times a class's length,
half overlapping. So each copy of an item lies whole in one of them, wherever it starts, also with words put in:
as many as a class's length in all, at the least. A copy drawn out further may be cut by all passages. Every
passage that has a shingle of any item queries the index for all items above their threshold. An item's threshold is the least BM25 score that a passage with OVERLAP of
its five-word shingles can have: its full score less the weights of as many terms as the missing shingles
can uncover, the heaviest ones. So retrieval loses nothing that verification would accept. Scores are divided
by the threshold, which is then 1 for all items. Document frequencies, the number of items and their mean length
are those of the whole benchmark, whatever blocks its items are sent in.

A hit is verified on the words themselves: OVERLAP of the shingles of the item and enough of those of its
question (the first three quarters of its words), and of the words of its answer (the rest).

Edge cases: null and empty texts and items without words have no hits; items of fewer than five words count as
one shingle; repeated items or documents each get their own rows; an empty benchmark leaves all documents clean;
extra columns are kept by `clean_documents` and ignored by `find_contamination`.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftfold.llm.common import column, materialize, once, slices, small_batches, texts_of

WORDS = re.compile(r"\w+")
SHINGLE = 5
#: Shares of the item's shingles, of its question's shingles and of its answer's words that a passage must hold.
OVERLAP, QUESTION, ANSWER = 0.75, 0.6, 0.6
#: BM25's saturation and length normalisation.
K1, B = 1.2, 0.75
#: Items of an index that is sent to the workers, characters of all its items, items in a block of a posting list.
ITEM_BLOCK, ITEM_CHARS, POSTING_BLOCK = 4_096, 8_000_000, 16
#: Shortest class of items in words; each next one is twice as long.
SHORTEST = 32
#: Length of a passage in class lengths, half of which may be an item with what has been put into it.
SPAN = 4
#: Words of the passages looked at together.
PASSAGE_WORDS = 1 << 18


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    if not words:
        return set()
    return {tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}


@dataclass
class Posting:
    """Items of a term in order, their weights, and the last item and the largest weight of each block."""

    items: list[int] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    most: float = 0.0
    last: list[int] = field(default_factory=list)
    block_most: list[float] = field(default_factory=list)

    def close(self) -> None:
        self.most = max(self.weights)
        for at in range(0, len(self.items), POSTING_BLOCK):
            self.last.append(self.items[min(at + POSTING_BLOCK, len(self.items)) - 1])
            self.block_most.append(max(self.weights[at : at + POSTING_BLOCK]))


@dataclass(frozen=True)
class Statistics:
    """Of the whole benchmark: items with words, their mean length, and how many of them hold a word."""

    n_items: int
    mean: float
    frequency: dict[str, int]

    @staticmethod
    def of(items: list[list[str]]) -> Statistics:
        return Statistics(len(items), sum(map(len, items)) / max(1, len(items)), Counter(t for words in items for t in set(words)))


class Index:
    """The items of one length class."""

    def __init__(self, items: list[tuple[int, list[str]]], longest: int, whole: Statistics):
        self.items, self.longest = items, longest
        self.terms: dict[str, int] = {}
        self.postings: list[Posting] = []
        for at, (_, words) in enumerate(items):
            counts = Counter(words)
            weights = {}
            for term, tf in counts.items():
                idf = np.log(1 + (whole.n_items - whole.frequency[term] + 0.5) / (whole.frequency[term] + 0.5))
                weights[term] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / whole.mean))
            m = len(shingles(words))
            uncovered = m - int(np.ceil(OVERLAP * m))
            threshold = sum(sorted(weights.values())[: max(1, len(weights) - uncovered)])
            for term, weight in weights.items():
                tid = self.terms.setdefault(term, len(self.terms))
                if tid == len(self.postings):
                    self.postings.append(Posting())
                self.postings[tid].items.append(at)
                self.postings[tid].weights.append(weight / threshold)
        for p in self.postings:
            p.close()
        grams = defaultdict(list)
        for _, words in items:
            n = min(SHINGLE, len(words))
            grams[n].append(self._hashes(np.array([self.terms[w] for w in words]), n))
        # Hashes of all shingles by length: that of items shorter than a shingle is their own.
        self.grams = {n: np.unique(np.concatenate(members)) for n, members in grams.items()}
        blocks = -(-len(items) // POSTING_BLOCK)
        # Bounds of every term: over all items, and over each run of POSTING_BLOCK items; the last row is for words that are no term.
        self.most = np.array([p.most for p in self.postings] + [0.0], dtype=np.float32)
        self.by_block = np.zeros((len(self.postings) + 1, blocks), dtype=np.float32)
        for tid, p in enumerate(self.postings):
            np.maximum.at(self.by_block[tid], np.array(p.items) // POSTING_BLOCK, np.array(p.weights, dtype=np.float32))

    def passages(self, n_words: int) -> list[tuple[int, int]]:
        """Start and end of the passages of a document of that many words."""
        whole, step = SPAN * self.longest, SPAN * self.longest // 2
        return [(at, min(n_words, at + whole)) for at in range(0, max(1, n_words - step), step)]

    @staticmethod
    def _hashes(ids: np.ndarray, n: int) -> np.ndarray:
        """A hash of the n term ids from each place on."""
        size = max(0, len(ids) - n + 1)
        out = np.zeros(size, dtype=np.uint64)
        for k in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + size].astype(np.uint64) + np.uint64(1)
        return out

    def shared(self, ids: np.ndarray) -> np.ndarray:
        """Where a shingle of an item starts; a passage without any cannot be verified for any item."""
        out = np.zeros(len(ids), dtype=bool)
        for n, known in self.grams.items():
            found = self._hashes(ids, n)
            out[: len(found)] |= known[np.minimum(np.searchsorted(known, found), len(known) - 1)] == found
        return out

    def promising(self, ids: np.ndarray) -> np.ndarray:
        """Which rows of term ids (sorted; the number of terms stands for none) can reach the threshold, by the terms' bounds, then by the blocks'."""
        # As in search, less what sums of float32 may lose.
        least = 0.9999 - ids.shape[1] * 2.0**-23
        fresh = np.ones(ids.shape, dtype=bool)
        fresh[:, 1:] = ids[:, 1:] != ids[:, :-1]
        found = np.flatnonzero((self.most[ids] * fresh).sum(1) >= least)
        kept = []
        some = max(1, PASSAGE_WORDS // 16 // ids.shape[1])
        for at in range(0, len(found), some):
            rows = found[at : at + some]
            bound = np.einsum("rpb,rp->rb", self.by_block[ids[rows]], fresh[rows].astype(np.float32))
            kept.append(rows[bound.max(1) >= least])
        return np.concatenate(kept) if kept else found

    def search(self, terms: list[int]) -> Iterator[tuple[int, float]]:
        """Block-max WAND: all items whose score over these distinct terms is 1 or more."""
        cursors = [[p.items[0], 0, p] for p in (self.postings[t] for t in terms)]
        while cursors:
            cursors.sort(key=itemgetter(0))
            bound, pivot = 0.0, None
            for at, c in enumerate(cursors):
                bound += c[2].most
                if bound >= 0.9999:
                    pivot = at
                    break
            if pivot is None:
                return
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            bound, end = 0.0, None
            for c in cursors[: pivot + 1]:
                p = c[2]
                block = bisect_left(p.last, item, c[1] // POSTING_BLOCK)
                if block < len(p.last):
                    bound += p.block_most[block]
                    end = p.last[block] if end is None else min(end, p.last[block])
            if bound >= 0.9999:
                if cursors[0][0] == item:
                    score = sum(c[2].weights[c[1]] for c in cursors[: pivot + 1])
                    if score >= 0.9999:
                        yield item, score
                    target = item + 1
                else:
                    target = item
            else:
                target = min([item + 1 if end is None else end + 1] + [c[0] for c in cursors[pivot + 1 : pivot + 2]])
                target = max(target, item + 1)
            for c in cursors[: pivot + 1]:
                items = c[2].items
                c[1] = at = bisect_left(items, target, c[1])
                c[0] = items[at] if at < len(items) else -1
            cursors = [c for c in cursors if c[0] >= 0]


@dataclass(frozen=True)
class Hit:
    item_id: int
    score: float
    overlap: float
    question: float
    answer: float


class Benchmark:
    """All classes of a set of items, and the documents' search through them."""

    def __init__(self, items: list[tuple[int, str]], whole: Statistics | None = None):
        """whole: the statistics of the benchmark that the items are a part of; by default these items are all of it."""
        split = [(i, words) for i, text in items if text and (words := words_of(text))]
        whole = whole or Statistics.of([words for _, words in split])
        classes = defaultdict(list)
        for i, words in split:
            longest = SHORTEST
            while longest < len(words):
                longest *= 2
            classes[longest].append((i, words))
        self.indexes = [Index(members, longest, whole) for longest, members in sorted(classes.items())]

    def hits(self, texts: list[str]) -> list[dict[int, Hit]]:
        """Per text the best verified hit of each item, by the item's position in the benchmark's class."""
        found: list[dict] = [{} for _ in texts]
        split = [words_of(t) for t in texts]
        for index in self.indexes:
            none = len(index.terms)
            get = index.terms.get
            ids = [np.array([get(w, none) for w in words], dtype=np.int32) for words in split]
            starts = np.cumsum([0, *map(len, ids)])
            before = np.append(0, np.cumsum(index.shared(np.concatenate(ids)))) if ids else np.zeros(1, np.int64)
            spans = [(d, a, b) for d, words in enumerate(split) if before[starts[d]] < before[starts[d + 1]] for a, b in index.passages(len(words)) if before[starts[d] + a] < before[starts[d] + b]]
            some = max(1, PASSAGE_WORDS // (SPAN * index.longest))
            for at in range(0, len(spans), some):
                self._search(index, spans[at : at + some], ids, split, found)
        return found

    def _search(self, index: Index, spans: list[tuple[int, int, int]], ids: list[np.ndarray], split: list[list[str]], found: list[dict]) -> None:
        none = len(index.terms)
        table = np.full((len(spans), SPAN * index.longest), none, dtype=np.int32)
        for row, (d, a, b) in enumerate(spans):
            table[row, : b - a] = ids[d][a:b]
        table.sort(axis=1)
        for row in index.promising(table):
            d, a, b = spans[row]
            terms = np.unique(table[row])
            passage = None
            for item, score in index.search(terms[terms < none].tolist()):
                if passage is None:
                    passage = split[d][a:b]
                    held, bag = self._grams(passage), Counter(passage)
                hit = self._verify(index.items[item], score, held, bag, passage)
                key = (index.longest, item)
                if hit and (key not in found[d] or found[d][key].overlap < hit.overlap):
                    found[d][key] = hit

    @staticmethod
    def _grams(passage: list[str]) -> set[tuple[str, ...]]:
        return {tuple(passage[i : i + SHINGLE]) for i in range(len(passage) - SHINGLE + 1)}

    @staticmethod
    def _verify(item: tuple[int, list[str]], score: float, held: set, bag: Counter, passage: list[str]) -> Hit | None:
        item_id, words = item
        if len(words) < SHINGLE:
            n = len(words)
            return Hit(item_id, score, 1.0, 1.0, 1.0) if any(passage[i : i + n] == words for i in range(len(passage) - n + 1)) else None
        own = shingles(words)
        overlap = len(own & held) / len(own)
        cut = max(SHINGLE, len(words) * 3 // 4)
        asked, answer = shingles(words[:cut]), Counter(words[cut:])
        question = len(asked & held) / len(asked)
        answered = sum((answer & bag).values()) / max(1, answer.total()) if answer else 1.0
        return Hit(item_id, score, overlap, question, answered) if overlap >= OVERLAP and question >= QUESTION and answered >= ANSWER else None


def item_words(benchmark: DataFrame) -> DataFrame:
    """(n, words): number of words and distinct words of every item that has any."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [x for x in map(words_of, texts_of(batch)) if x]
            yield pa.RecordBatch.from_arrays([pa.array([len(x) for x in found], pa.int64()), pa.array([sorted(set(x)) for x in found], pa.list_(pa.string()))], names=["n", "words"])

    return benchmark.select("text").where("text is not null").mapInArrow(split, "n long, words array<string>")


def item_blocks(benchmark: DataFrame) -> Iterator[tuple[list[tuple[int, str]], Statistics]]:
    """The items, read a partition at a time, in blocks that bound the index sent to workers, with the whole benchmark's statistics of their words."""
    split = materialize(item_words(benchmark), "items")
    n_items, mean = split.agg(F.count("*"), F.coalesce(F.avg("n"), F.lit(0.0))).collect()[0]
    frequency = materialize(split.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")), "frequency")

    def with_statistics(block: list[tuple[int, str]]) -> tuple[list[tuple[int, str]], Statistics]:
        own = pa.table({"word": pa.array(sorted({w for _, text in block for w in words_of(text)}), pa.string())})
        found = frequency.join(benchmark.sparkSession.createDataFrame(own), "word").select("word", "n").toArrow() if own.num_rows else None
        return block, Statistics(n_items, mean, dict(zip(*(found.column(c).to_pylist() for c in ("word", "n")), strict=True)) if found else {})

    block, size = [], 0
    for row in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        if block and (len(block) >= ITEM_BLOCK or size + len(row["text"]) > ITEM_CHARS):
            yield with_statistics(block)
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += len(row["text"])
    if block:
        yield with_statistics(block)


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, overlap, question_overlap and answer_overlap of every verified hit."""
    spark = small_batches(docs).sparkSession
    types = [docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()]
    schema = f"doc_id {types[0]}, item_id {types[1]}, score double, overlap double, question_overlap double, answer_overlap double"
    found = None
    for block in item_blocks(benchmark):
        sent, key = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def search(batches: Iterator[pa.RecordBatch], sent=sent, key=key) -> Iterator[pa.RecordBatch]:
            items = once(key, lambda: Benchmark(*sent.value))
            for batch in slices(batches):
                ids = column(batch, "doc_id").to_pylist()
                rows = [(ids[d], h.item_id, h.score, h.overlap, h.question, h.answer) for d, hits in enumerate(items.hits(texts_of(batch))) for h in hits.values()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"])

        part = docs.select("doc_id", "text").mapInArrow(search, schema)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], schema) if found is None else found


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit, with all their columns."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in small_batches(docs).schema.fields)
    for block in item_blocks(benchmark):
        sent, key = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

        def keep(batches: Iterator[pa.RecordBatch], sent=sent, key=key) -> Iterator[pa.RecordBatch]:
            items = once(key, lambda: Benchmark(*sent.value))
            for batch in slices(batches):
                yield batch.filter(pa.array([not hits for hits in items.hits(texts_of(batch))], pa.bool_()))

        docs = docs.mapInArrow(keep, schema)
    return docs
