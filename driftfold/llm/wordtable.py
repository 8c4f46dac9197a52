"""Distinct words of a corpus with their counts, and the bounded head of that table that a worker may hold."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftfold.llm.common import slices, texts_of

#: Distinct words a task holds before it passes its counts on.
FLUSH = 250_000
#: The head of a table: at most so many words of at most so many bytes, the commonest ones. This bounds what is broadcast.
HEAD_WORDS, HEAD_BYTES = 400_000, 32
#: Long words have a head of their own, so that a long word of very many documents is no hot key of a join either.
LONG_WORDS, LONG_BYTES = 2_000, 4_096


def count_words(docs: DataFrame, splitter: Callable[[], Callable[[str], list]], weight: str | None = None, binary: bool = False) -> DataFrame:
    """(word, n, n_weighted): occurrences in all texts, and in those where the boolean column `weight` holds.

    splitter() gives the function that splits a text, into strings or, with `binary`, bytes.

    Tasks add up their own counts first, so a word that is everywhere is sent once a task and not once an occurrence.
    """
    columns = [F.col("text"), (F.col(weight) if weight else F.lit(True)).alias("weight")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter()
        plain, weighted = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            words = [*weighted, *(w for w in plain if w not in weighted)]
            batch = pa.RecordBatch.from_arrays([pa.array(words, pa.binary() if binary else pa.string()), pa.array([plain[w] + weighted[w] for w in words], pa.int64()), pa.array([weighted[w] for w in words], pa.int64())], names=["word", "n", "n_weighted"])
            plain.clear()
            weighted.clear()
            return batch

        for batch in slices(batches):
            for text, counts in zip(texts_of(batch), batch.column(1).to_pylist(), strict=True):
                (weighted if counts else plain).update(split(text))
            if len(plain) + len(weighted) >= FLUSH:
                yield flush()
        if plain or weighted:
            yield flush()

    parts = docs.select(*columns).mapInArrow(count, f"word {'binary' if binary else 'string'}, n long, n_weighted long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_weighted").alias("n_weighted"))


def head_of(words: DataFrame, limit: int = HEAD_WORDS) -> DataFrame:
    """The commonest words of at most HEAD_BYTES bytes, and of the longer ones up to LONG_BYTES.

    Each kind ends at the least level of counts that keeps it within its limit. Levels are eighths of powers of
    two, so the histogram that decides has a few hundred rows for any corpus.
    """
    size = F.octet_length("word")
    sized = words.where(size <= LONG_BYTES).withColumn("level", F.floor(F.log2("n") * 8).cast("int")).withColumn("long", size > HEAD_BYTES)
    room, least = {False: limit, True: min(limit, LONG_WORDS)}, {False: None, True: None}
    for row in sized.groupBy("long", "level").count().orderBy(F.desc("level")).collect():
        kind = row["long"]
        room[kind] -= row["count"]
        # A kind that is over its limit stays so, and takes no lower level.
        if room[kind] >= 0:
            least[kind] = row["level"]
    kept = [(F.col("long") == kind) & (F.col("level") >= level) for kind, level in least.items() if level is not None]
    return sized.where(kept[0] | kept[1] if len(kept) == 2 else kept[0] if kept else F.lit(False)).drop("level", "long")
