"""Nearest neighbours by additive quantisation, with exact reranking.

A vector is approximated by the sum of one codeword from each of several codebooks over all its dimensions.
The books are fitted to residuals on a bounded sample, encoding keeps a beam of the best partial sums, and the
norm of each approximation is stored: the squared distance to a query is then that norm minus twice a sum of
table lookups, up to a term of the query's own.

Queries and codes are tables, dealt out by block of queries and part of the index; a task holds one block and
streams the codes of its part past it, keeping RERANK candidates a query. The RERANK best of all parts, by
approximate distance and then vec_id, are compared exactly on the original vectors. What a query gets depends on
the books alone, not on how rows were dealt, batched or partitioned. Every code is scored for every query, so the
lookups grow as rows times queries; exact comparisons are RERANK a query, whatever the number of rows.

Edge cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do those of
another length than most: no Euclidean distance to these exists. Equal distances go to the smaller vec_id; each
row of a repeated vec_id is a candidate (not for that vec_id's query), and the query is the least of its vectors;
fewer candidates than k give all of them; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftfold.llm.common import column, hash_sample, materialize, trim

NEAREST, QUERY_EVERY = 10, 100
#: Bounds of the fit: vectors in the sample, codebooks, codewords in each, rounds of each book's fit.
SAMPLE, BOOKS, WORDS, ROUNDS = 8_192, 32, 128, 8
#: Partial sums kept while encoding, and candidates that are reranked for a query.
BEAM, RERANK = 4, 256
#: Most queries in a block, vectors in a part of the index, vectors scored at once, and queries scored at once.
QUERY_BLOCK, PART, VECTOR_BLOCK, QUERIES = 1 << 15, 1 << 22, 8_192, 256


@dataclass(frozen=True)
class Books:
    """Codebooks as one array, books x words x dimensions."""

    words: np.ndarray

    @property
    def dims(self) -> int:
        return self.words.shape[2]

    @staticmethod
    def fit(sample: np.ndarray, seed: int = 5) -> Books:
        """One k-means after another, each on what the books before it leave over."""
        rng = np.random.default_rng(seed)
        rest, books = sample.astype(np.float64), []
        for _ in range(BOOKS):
            words = rest[rng.choice(len(rest), WORDS, replace=len(rest) < WORDS)]
            for _ in range(ROUNDS):
                near = ((words**2).sum(1) - 2 * rest @ words.T).argmin(1)
                sums = np.zeros_like(words)
                np.add.at(sums, near, rest)
                counts = np.bincount(near, minlength=WORDS)
                words = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], words)
            near = ((words**2).sum(1) - 2 * rest @ words.T).argmin(1)
            rest = rest - words[near]
            books.append(words)
        return Books(np.stack(books))

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (vectors x books) and the norm of each approximation, by beam search over the books."""
        n = len(vectors)
        kept = np.zeros((n, 1, 0), dtype=np.uint8)
        rest = vectors[:, None, :].astype(np.float64)
        for words in self.words:
            error = (rest**2).sum(2)[:, :, None] + (words**2).sum(1) - 2 * rest @ words.T
            flat = error.reshape(n, -1)
            width = min(BEAM, flat.shape[1])
            best = np.argpartition(flat, width - 1, axis=1)[:, :width]
            beam, word = best // len(words), best % len(words)
            rows = np.arange(n)[:, None]
            kept = np.concatenate((kept[rows, beam], word[:, :, None].astype(np.uint8)), axis=2)
            rest = rest[rows, beam] - words[word]
        last = (rest**2).sum(2).argmin(1)
        rows = np.arange(n)
        return kept[rows, last], ((vectors - rest[rows, last]) ** 2).sum(1)

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """Inner products of queries with all codewords, queries x books x words."""
        return np.einsum("qd,bwd->qbw", queries, self.words).astype(np.float32)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the vectors that take part."""
    x = F.col("embedding").cast("array<double>")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    rows = vectors.select("vec_id", x.alias("embedding")).where(F.col("vec_id").isNotNull() & x.isNotNull() & good)
    sizes = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("embedding") == (sizes[0]["n"] if sizes else 0))


def matrix(batch: pa.RecordBatch, name: str = "embedding") -> np.ndarray:
    found = column(batch, name)
    return found.flatten().to_numpy(zero_copy_only=False).reshape(len(found), -1) if len(found) else np.zeros((0, 0))


def fit_books(rows: DataFrame) -> Books | None:
    """Books fitted to the SAMPLE vectors of smallest id hash."""
    found = hash_sample(rows, "vec_id", SAMPLE).select("embedding").toArrow().combine_chunks()
    return Books.fit(matrix(found.to_batches()[0])) if found.num_rows else None


def build_index(rows: DataFrame, books: Broadcast) -> DataFrame:
    """The written index: row (a number of its own), vec_id, embedding, codes and norm of every vector."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, VECTOR_BLOCK // 8):
                batch = whole.slice(at, VECTOR_BLOCK // 8)
                codes, norms = books.value.encode(matrix(batch))
                yield pa.RecordBatch.from_arrays([column(batch, "vec_id"), column(batch, "embedding"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norms.astype(np.float32))], names=["vec_id", "embedding", "codes", "norm"])
        trim()

    encoded = rows.mapInArrow(encode, "vec_id long, embedding array<double>, codes binary, norm float")
    return materialize(encoded.withColumn("row", F.monotonically_increasing_id()), "vectors")


def least(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions, rising, of the k least scores of each row; at the k-th score the first positions win."""
    n = scores.shape[1]
    if k >= n:
        return np.broadcast_to(np.arange(n), scores.shape)
    edge = np.partition(scores, k - 1, axis=1)[:, k - 1 : k]
    below = scores < edge
    ties = scores == edge
    taken = below | (ties & (np.cumsum(ties, axis=1, dtype=np.int32) <= k - below.sum(axis=1, keepdims=True)))
    return np.nonzero(taken)[1].reshape(len(scores), k)


@dataclass
class Block:
    """A block of queries and its best candidates so far, each query's in the order of their rising vec_id."""

    books: Books
    ids: list[np.ndarray] = field(default_factory=list)
    vectors: list[np.ndarray] = field(default_factory=list)
    waiting: list[tuple[np.ndarray, ...]] = field(default_factory=list)
    rows: np.ndarray | None = None
    scores: np.ndarray | None = None

    def ask(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids.append(ids)
        self.vectors.append(vectors)

    def offer(self, ids: np.ndarray, rows: np.ndarray, norms: np.ndarray, codes: np.ndarray) -> None:
        self.waiting.append((ids, rows, norms, codes))
        if sum(len(x[0]) for x in self.waiting) >= VECTOR_BLOCK:
            self.score()

    def score(self) -> None:
        if not self.waiting or not self.ids:
            return
        ids, rows, norms, codes = (np.concatenate(x) for x in zip(*self.waiting, strict=True))
        self.waiting.clear()
        asked, vectors = np.concatenate(self.ids), np.concatenate(self.vectors)
        self.ids, self.vectors = [asked], [vectors]
        held = 0 if self.scores is None else self.scores.shape[1]
        k = min(RERANK, held + len(ids))
        new_rows, new_scores = np.empty((len(asked), k), np.int64), np.empty((len(asked), k), np.float32)
        for at in range(0, len(asked), QUERIES):
            some = slice(at, at + QUERIES)
            tables = self.books.tables(vectors[some])
            scores = np.repeat(norms[None, :], len(tables), axis=0)
            for book in range(codes.shape[1]):
                scores -= 2 * tables[:, book][:, codes[:, book]]
            scores[asked[some, None] == ids[None, :]] = np.inf
            if held:
                scores = np.concatenate((self.scores[some], scores), axis=1)
            best = least(scores, k)
            new_scores[some] = np.take_along_axis(scores, best, axis=1)
            fresh = rows[np.maximum(best - held, 0)]
            new_rows[some] = np.where(best < held, np.take_along_axis(self.rows[some], np.minimum(best, held - 1), axis=1), fresh) if held else fresh
        self.rows, self.scores = new_rows, new_scores

    def found(self) -> Iterator[pa.RecordBatch]:
        self.score()
        if self.scores is None:
            return
        asked = self.ids[0]
        for at in range(0, len(asked), QUERIES):
            rows, scores = self.rows[at : at + QUERIES], self.scores[at : at + QUERIES]
            there = np.isfinite(scores)
            owner = np.repeat(asked[at : at + QUERIES], there.sum(1))
            yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(rows[there]), pa.array(scores[there])], names=["query_id", "row", "near"])


def candidates(index: DataFrame, queries: DataFrame, books: Broadcast) -> DataFrame:
    """(query_id, row, near): of every part of the index the RERANK rows of least approximate distance to each query."""
    spark = index.sparkSession
    parallel = spark.sparkContext.defaultParallelism
    n, asked = index.count(), queries.count()
    blocks = -(-asked // QUERY_BLOCK)
    parts = max(-(-n // PART), min(2 * parallel, -(-n // 1024)), 1)

    def numbers(of: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(of - 1)))

    # Queries come before the codes of their block and part, codes by rising vec_id.
    left = queries.select(F.pmod(F.xxhash64("query_id"), F.lit(max(1, blocks))).cast("int").alias("block"), numbers(parts).alias("part"), F.lit(0).alias("side"), F.col("query_id").alias("id"), F.lit(0).cast("long").alias("row"), F.lit(0).cast("float").alias("norm"), "embedding", F.lit(None).cast("binary").alias("codes"))
    right = index.select(numbers(max(1, blocks)).alias("block"), F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("side"), F.col("vec_id").alias("id"), "row", "norm", F.lit(None).cast("array<double>").alias("embedding"), "codes")
    dealt = left.unionByName(right).repartition(max(parts * max(1, blocks), parallel), "block", "part").sortWithinPartitions("block", "part", "side", "id", "row")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, None
        for batch in batches:
            keys = np.stack([column(batch, c).to_numpy() for c in ("block", "part", "side")], axis=1)
            edges = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))) if len(keys) else []
            for start, end in zip(edges, [*edges[1:], len(keys)], strict=True):
                piece = batch.slice(start, end - start)
                if key != (own := tuple(keys[start, :2])):
                    if block:
                        yield from block.found()
                    key, block = own, Block(books.value)
                ids = column(piece, "id").to_numpy()
                if keys[start, 2] == 0:
                    block.ask(ids, matrix(piece))
                else:
                    codes = np.frombuffer(b"".join(column(piece, "codes").to_pylist()), np.uint8).reshape(len(ids), -1)
                    block.offer(ids, column(piece, "row").to_numpy(), column(piece, "norm").to_numpy(), codes)
        if block:
            yield from block.found()
        trim()

    return dealt.mapInArrow(scan, "query_id long, row long, near float")


def search(index: DataFrame, queries: DataFrame, books: Broadcast, k: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k nearest: all queries against every vector."""
    ids = index.select("row", "vec_id")
    found = candidates(index, queries, books).join(ids, "row")
    best = Window.partitionBy("query_id").orderBy("near", "vec_id", "row")
    kept = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= RERANK).select("query_id", "row")
    pairs = kept.join(index.select("row", "vec_id", "embedding"), "row").join(queries.select("query_id", F.col("embedding").alias("asked")), "query_id")
    apart = F.aggregate(F.zip_with("embedding", "asked", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x)
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id", "row")
    ranked = pairs.select("query_id", "vec_id", "row", F.sqrt(apart).alias("score")).withColumn("rank", F.row_number().over(nearest))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, every: int = QUERY_EVERY, k: int = NEAREST) -> DataFrame:
    """Search all vectors for the neighbours of those whose vec_id is divisible by `every`."""
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    rows = usable(vectors.withColumn("vec_id", F.col("vec_id").cast("long")))
    fitted = fit_books(rows)
    if fitted is None:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    books = spark.sparkContext.broadcast(fitted)
    index = build_index(rows, books)
    queries = index.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("embedding").alias("embedding"))
    found = search(index, materialize(queries, "queries"), books, k)
    return found.select(F.col("query_id").cast(kind), "rank", F.col("vec_id").cast(kind), "score")
