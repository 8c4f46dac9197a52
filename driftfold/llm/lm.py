"""Language model scores: prediction by partial matching over bytes, and a word-unigram base.

The byte-context trie is held as counts of grams of ORDER + 1 bytes, gathered from all training texts; the
shorter contexts' counts are sums of these. A byte is predicted in the longest context seen in training; an
unseen byte escapes to the next shorter one with probability distinct / (total + distinct) (method C), and
symbols of the longer context are excluded there; below the empty context all other bytes are equal. A
document's score is the pretrained code length, negated, in log10: its tokens joined by spaces, then an end.

All counts are kept, of grams as of words; what is sent to workers is the head of each table, for speed: the
commonest words (see wordtable) and the commonest NODES full-length grams at most, with probabilities from all
counts. Tokens outside the head meet their counts in a join. Grams outside it are gathered, distinct ones once,
and dealt out with the whole table by the LOW + 1 bytes before the last one, so that each part has all counts
of the contexts longer than LOW that its grams escape through; those of the shorter ones, at most 2^24 grams of
LOW + 1 bytes for any corpus, are sent to all.

Edge cases: null and empty texts consist of the end token; a null doc_id is in the training part; repeated
rows count and score each; with no training texts all bytes are equal and no token is known.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftfold.llm.common import column, discard, fold_of, materialize, once, slices, small_batches, texts_of, trim
from driftfold.llm.wordtable import count_words, head_of

FOLDS, HELD_OUT = 7, 2
ORDER = 5
END = b"\n"
NODES = 1 << 21
#: Contexts of at most so many bytes are counted for all parts together; distinct grams in a part, about.
LOW, PART = 2, 1 << 18
#: Bytes scored or counted at once, and distinct grams a task holds before it passes them on.
CHUNK, HELD = 1 << 20, 1 << 20
#: No gram of ORDER + 1 bytes has this code.
EMPTY = np.uint64(2**64 - 1)


def tokens_of(text: str) -> list[bytes]:
    """The contract's words, in UTF-8: bytes.lower and bytes.split touch A-Z and the six ASCII splitters alone."""
    return text.encode().lower().split()


def stream(tokens: list[bytes]) -> bytes:
    return b" ".join(tokens) + END


def gram_codes(streams: list[bytes]) -> np.ndarray:
    """The gram that ends at every byte of the streams, as an integer; each stream starts after ORDER zero bytes."""
    pad = bytes(ORDER)
    raw = np.frombuffer(b"".join(x for s in streams for x in (pad, s)), dtype=np.uint8).astype(np.uint64)
    codes = np.zeros(len(raw) - ORDER, dtype=np.uint64)
    for k in range(ORDER + 1):
        codes |= raw[k : k + len(codes)] << np.uint64(8 * (ORDER - k))
    keep = np.ones(len(codes), dtype=bool)
    at = 0
    for s in streams[:-1]:
        at += len(s)
        keep[at : at + ORDER] = False
        at += ORDER
    return codes[keep]


def chunks(streams: list[bytes]) -> Iterator[list[int]]:
    """Indexes of streams, grouped to about CHUNK bytes."""
    group, size = [], 0
    for i, s in enumerate(streams):
        if group and size + len(s) > CHUNK:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(s)
    if group:
        yield group


def count_grams(docs: DataFrame) -> DataFrame:
    """(gram, n) over the texts, added up in each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts, pending = np.zeros(0, np.uint64), np.zeros(0, np.int64), []

        def merge() -> None:
            nonlocal grams, counts
            keys = np.concatenate([grams, *(k for k, _ in pending)])
            values = np.concatenate([counts, *(v for _, v in pending)])
            order = np.argsort(keys)
            keys, values = keys[order], values[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
            grams, counts = keys[first], np.add.reduceat(values, first) if len(first) else values
            pending.clear()

        def rows() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(grams), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(grams[at : at + 200_000].astype(np.int64)), pa.array(counts[at : at + 200_000])], names=["gram", "n"])

        for batch in slices(batches):
            streams = [stream(tokens_of(t)) for t in texts_of(batch)]
            for group in chunks(streams):
                codes = np.sort(gram_codes([streams[i] for i in group]))
                first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
                pending.append((codes[first], np.diff(np.append(first, len(codes)))))
                if len(pending) >= 4:
                    merge()
            if len(grams) >= HELD:
                merge()
                yield from rows()
                grams, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        merge()
        yield from rows()

    return docs.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


@dataclass
class Trie:
    """Sorted full-length grams with counts; `logs`, where given, are their log10 probabilities by counts of more grams than these."""

    grams: np.ndarray
    counts: np.ndarray
    logs: np.ndarray | None = None


class Level:
    """Grams of one length: counts, and per context total, distinct symbols and what the parent level excludes for it."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.grams, self.counts = grams, counts
        contexts = grams >> np.uint64(8)
        self.first = np.flatnonzero(np.concatenate(([True], contexts[1:] != contexts[:-1]))) if len(grams) else np.zeros(0, np.int64)
        self.contexts = contexts[self.first]
        self.total = np.add.reduceat(counts, self.first) if len(grams) else np.zeros(0, np.int64)
        self.distinct = np.diff(np.append(self.first, len(grams)))
        self.excluded = np.zeros(len(self.contexts), np.int64)

    def context(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return lookup(self.contexts, codes >> np.uint64(8))

    def gram(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return lookup(self.grams, codes)


def lookup(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of each key in the sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def mask(size: int) -> int:
    """The last `size` bytes of a gram."""
    return (1 << 8 * size) - 1


def levels_of(grams: np.ndarray, counts: np.ndarray, low: tuple[np.ndarray, np.ndarray] | None = None) -> list[Level]:
    """The levels from full length down to the empty context; from contexts of LOW bytes on by the grams and counts in `low`, where given."""
    levels = [Level(grams, counts)]
    for k in range(ORDER - 1, -1, -1):
        above = levels[-1]
        if low is not None and k == LOW:
            level = Level(*low)
        else:
            short, back = np.unique(above.grams & np.uint64(mask(k + 1)), return_inverse=True)
            level = Level(short, np.bincount(back, weights=above.counts, minlength=len(short)).astype(np.int64))
        at, _ = level.gram(above.grams & np.uint64(mask(k + 1)))
        if len(above.grams):
            above.excluded = np.add.reduceat(level.counts[at], above.first)
        levels.append(level)
    return levels


def escaped(levels: list[Level], codes: np.ndarray) -> np.ndarray:
    """log10 P of the last byte of any grams, by walking down the contexts."""
    out = np.zeros(len(codes))
    done = np.zeros(len(codes), bool)
    seen = np.zeros(len(codes), np.int64)  # total and distinct symbols that the longer context excludes here
    kinds = np.zeros(len(codes), np.int64)
    for k, level in enumerate(levels):
        masked = codes & np.uint64(mask(ORDER - k + 1))
        ctx, known = level.context(masked)
        at, hit = level.gram(masked)
        if not len(level.contexts):
            continue
        total, distinct = level.total[ctx] - seen, level.distinct[ctx] - kinds
        base = np.maximum(total + distinct, 1)
        use = known & ~done & (distinct > 0)
        ends = use & hit
        out[ends] += np.log10(level.counts[at[ends]] / base[ends])
        done |= ends
        goes = use & ~hit
        out[goes] += np.log10(distinct[goes] / base[goes])
        seen = np.where(known, level.excluded[ctx], 0)
        kinds = np.where(known, level.distinct[ctx], 0)
    out[~done] -= np.log10(256 - kinds[~done])
    return out


class Hashed:
    """Grams and their log10 probabilities by open addressing."""

    def __init__(self, grams: np.ndarray, logs: np.ndarray):
        """Filled in rounds: of the grams that want a free slot one gets it, the others move on."""
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(grams)) * 1.4))))
        self.keys = np.full(1 << self.bits, EMPTY)
        self.logs = np.zeros(1 << self.bits, dtype=np.float32)
        left, slot = np.arange(len(grams)), self.slot(grams)
        while len(left):
            free = self.keys[slot] == EMPTY
            self.keys[slot[free]] = grams[left[free]]
            won = self.keys[slot] == grams[left]
            self.logs[slot[won]] = logs[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & (len(self.keys) - 1)

    def slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 P of the last byte of each gram after the bytes before it, 0 where the gram is not here; the positions of those."""
        slot = self.slot(codes)
        keys, out = self.keys[slot], self.logs[slot].astype(np.float64)
        left = np.flatnonzero(keys != codes)
        out[left] = 0
        slot, keys, missing = slot[left], keys[left], [left[:0]]
        while len(left):
            empty = keys == EMPTY
            missing.append(left[empty])
            left, slot = left[~empty], (slot[~empty] + 1) & (len(self.keys) - 1)
            keys = self.keys[slot]
            hit = keys == codes[left]
            out[left[hit]] = self.logs[slot[hit]]
            left, slot, keys = left[~hit], slot[~hit], keys[~hit]
        return out, np.sort(np.concatenate(missing))


class Scorer:
    """log10 probabilities by one trie: a hash table for grams of full length, the escape chain for the rest."""

    def __init__(self, trie: Trie):
        self.levels = levels_of(trie.grams, trie.counts)
        top, logs = self.levels[0], trie.logs
        if logs is None:
            of = np.repeat(np.arange(len(top.contexts)), top.distinct)
            logs = np.log10(top.counts / (top.total + top.distinct)[of]) if len(top.grams) else np.zeros(0)
        self.hashed = Hashed(top.grams, logs)

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """log10 P of the last byte of each gram after the bytes before it."""
        out, absent = self.hashed.find(codes)
        distinct, back = np.unique(codes[absent], return_inverse=True)
        out[absent] = escaped(self.levels, distinct)[back]
        return out


def head_trie(counted: DataFrame, nodes: int) -> Trie:
    """The commonest grams of a table of all, at most `nodes`, level by level; their probabilities are by all counts."""
    level = F.floor(F.log2("n") * 8).cast("int")
    kept, least = 0, None
    for row in counted.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        if kept + row["count"] > nodes:
            break
        kept, least = kept + row["count"], row["level"]
    context = Window.partitionBy(F.shiftright("gram", 8))
    logs = counted.withColumn("log", F.log10(F.col("n") / (F.sum("n").over(context) + F.count("*").over(context))))
    found = logs.where(F.lit(False) if least is None else level >= least).toArrow()
    grams = found.column("gram").to_numpy().astype(np.uint64)
    order = np.argsort(grams)
    return Trie(grams[order], found.column("n").to_numpy()[order], found.column("log").to_numpy()[order].astype(np.float32))


def train_trie(docs: DataFrame, nodes: int = NODES) -> Trie:
    """The head of the texts' grams, at most `nodes`."""
    counted = materialize(count_grams(docs), "grams")
    head = head_trie(counted, nodes)
    discard(counted)
    return head


def gram_logs(counted: DataFrame, asked: DataFrame) -> DataFrame:
    """(gram, log) for distinct grams, seen or not, by all counts of the table `counted`."""
    spark = counted.sparkSession
    short = counted.groupBy(F.col("gram").bitwiseAND(mask(LOW + 1)).alias("gram")).agg(F.sum("n").alias("n")).toArrow()
    grams = short.column("gram").to_numpy().astype(np.uint64)
    order = np.argsort(grams)
    low = spark.sparkContext.broadcast((grams[order], short.column("n").to_numpy()[order]))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(column(b, "gram").to_numpy().astype(np.uint64), column(b, "n").to_numpy()) for b in batches]
        if not parts:
            return
        grams, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        parts.clear()
        asks, grams, n = grams[n == 0], grams[n > 0], n[n > 0]
        order = np.argsort(grams)
        levels = levels_of(grams[order], n[order], low.value)
        for at in range(0, len(asks), 200_000):
            some = asks[at : at + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64)), pa.array(escaped(levels, some))], names=["gram", "log"])
        trim()

    both = counted.select("gram", "n").unionByName(asked.select("gram", F.lit(0).cast("long").alias("n")))
    parts = max(spark.sparkContext.defaultParallelism, counted.count() // PART)
    return both.repartition(parts, F.shiftright("gram", 8).bitwiseAND(mask(LOW + 1))).mapInArrow(walk, "gram long, log double")


def known_head(head: pa.Table) -> tuple[dict[bytes, int], np.ndarray]:
    return {w: i for i, w in enumerate(head.column("word").to_pylist())}, head.column("n_weighted").to_numpy()


def _splitter() -> Callable[[str], list[bytes]]:
    return tokens_of


def score_documents(docs: DataFrame, nodes: int = NODES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = small_batches(docs).sparkSession
    fold = fold_of("doc_id", FOLDS)
    rows = docs.select("doc_id", "text", (fold == HELD_OUT).alias("held_out"), (fold != HELD_OUT).alias("learn"))
    words = materialize(count_words(rows, _splitter, "learn", binary=True), "words")
    totals = words.agg(F.sum("n_weighted").alias("n"), F.count_if(F.col("n_weighted") > 0).alias("v")).collect()[0]
    ends = rows.where("learn").count()
    n_train, v_train = (totals["n"] or 0) + ends, (totals["v"] or 0) + (ends > 0)
    head = spark.sparkContext.broadcast(head_of(words).select("word", "n_weighted").toArrow())
    grams = materialize(count_grams(rows.where("learn")), "grams")
    trie = spark.sparkContext.broadcast(head_trie(grams, nodes))
    key = uuid.uuid4().hex

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, (index, counts) = once(key + "trie", lambda: Hashed(trie.value.grams, trie.value.logs)), once(key + "head", lambda: known_head(head.value))
        logs = np.log10(np.append(counts, 0) + 1.0)
        for batch in slices(batches):
            n_tokens, n_known, base, rare, streams = [], [], [], [], []
            for text in texts_of(batch):
                tokens = tokens_of(text)
                at = np.fromiter(map(index.get, tokens, repeat(-1)), np.int64, len(tokens))
                n_tokens.append(len(tokens) + 1)
                n_known.append(int((counts[at] > 0)[at >= 0].sum() if len(counts) else 0) + (ends > 0))
                base.append(float(logs[at].sum() + np.log10(ends + 1.0)))
                rare.append([tokens[i] for i in np.flatnonzero(at < 0)])
                streams.append(stream(tokens))
            scores, offsets, absent = np.zeros(len(streams)), [np.zeros(1, np.int64)], []
            for group in chunks(streams):
                codes, sizes = gram_codes([streams[i] for i in group]), [len(streams[i]) for i in group]
                each, at = model.find(codes)
                scores[group] = np.add.reduceat(each, np.cumsum([0, *sizes[:-1]]))
                # The distinct grams of each text that the head lacks, and how often they occur there.
                owner, codes = np.repeat(np.arange(len(group)), sizes)[at], codes[at]
                order = np.lexsort((codes, owner))
                owner, codes = owner[order], codes[order]
                first = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (codes[1:] != codes[:-1])))) if len(codes) else np.zeros(0, np.int64)
                absent.append((codes[first].astype(np.int64), np.diff(np.append(first, len(codes)))))
                offsets.append(offsets[-1][-1] + np.cumsum(np.bincount(owner[first], minlength=len(group))))
            pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*absent, strict=True)], names=["gram", "times"])
            absent = pa.ListArray.from_arrays(pa.array(np.concatenate(offsets), pa.int32()), pairs)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), column(batch, "held_out"), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(scores), pa.array(rare, pa.list_(pa.binary())), absent], names=["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare", "absent"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<binary>, absent array<struct<gram: bigint, times: bigint>>")
    # Written, so that the generated row number means the same row in all uses below.
    scored = materialize(parts.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.explode("rare").alias("word")).join(words.where("n_weighted > 0").select("word", "n_weighted"), "word")
    found = rare.groupBy("row").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n_weighted") + 1.0)).alias("logs"))
    absent = scored.select("row", F.inline("absent"))
    logs = materialize(gram_logs(grams, absent.select("gram").distinct()), "logs")
    discard(grams)
    escapes = absent.join(logs, "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("log")).alias("escapes"))
    return scored.drop("rare", "absent").join(found, "row", "left").join(escapes, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("logs", F.lit(0.0)) - F.col("n_tokens") * float(np.log10(n_train + v_train + 1))).alias("base_score"),
        (F.col("score") + F.coalesce("escapes", F.lit(0.0))).alias("score"),
    )
