"""N-gram Jaccard join in a metric space: pivots, Voronoi regions, windows, and recursion until all links are in.

A document is the set of its five-word shingles; two link when 7 * |x & y| >= 3 * (|x| + |y|), which is a Jaccard
distance of 1/4 at most.

Pivot documents are sampled, and every set's exact distance to those that share a shingle with it is computed where
the set is made. A set within 1/4 of a pivot links with it and belongs to the region of its nearest one. By the
triangle inequality whatever links with a member of a region lies within 1/2 of its pivot: these boundary sets are
copied into the region (its window) and compared with those members that the inequality leaves, block by block:
|d(x, p) - d(y, p)| <= 1/4. So members of regions meet nothing else.

Sets that no sampled pivot is near cannot be dealt out like this: unrelated documents share no shingle, so they are
all at distance 1 from it and from each other. For this rest the pivots are the shingles themselves, in an order
that puts those of many documents last. A set may lack |x| - ceil(3/4 |x|) of its members in a set it links with,
so both are among the sets of one of its first |x| - ceil(3/4 |x|) + 1 members: the regions into which it is copied
(which is prefix filtering). Every pair that links meets in some region.

Regions of shingles are then joined recursively. First, in each region the smallest set is a pivot of its own and the
others within reach of its size are compared with it; then those that still lie in another component than a large
region's next member are compared with that. What still lies in two components of a region is compared exhaustively:
in small regions all pairs of sizes within the ratio that share as many pivots as a link needs; large regions are
grouped into families, and a family is joined block by block, where the counts of a set's members in CLASSES
classes of shingles (its distances to as many pivots) rule out most pairs by the triangle inequality before two
sets are compared. Pairs inside one component need no comparison, and blocks of one component none at all, so a
group of thousands of near copies costs about as many comparisons as it has members.

Shingles are 64-bit hashes, made of words' hashes by polynomials modulo two primes. Sets of one or two shingles link
with equal sets alone, and these are found by 128-bit digests of the words; any other link rests on three common
shingles or more, so a wrong one takes a collision within a pair that shares all others.

Edge cases: null and empty texts have no shingles and no links; fewer than five words are one shingle; rows of
equal doc_id are one document, linked by whatever any of its texts links with; rows of null doc_id have no links
and a null component; an empty table gives an empty result; extra columns are ignored. doc_id is an integer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftfold.llm.common import column, discard, forget, hash_sample, materialize, sized, slices, small_batches, texts_of
from driftfold.llm.components import components

SHINGLE = 5
#: Documents of a shingle from which it counts as common, and most common shingles that are sent to the workers.
COMMON, MOST_COMMON = 16, 2_000_000
#: Share of all hashes, from the least, in which common shingles are looked for: windows rarely reach beyond.
LOW = 0.4
#: Shingles and pivots a task holds before it passes them on.
COUNTED, PIVOTS = 2_000_000, 750_000
#: Sets of a region from which it counts as large; sets in a block of a family; classes of shingles.
LARGE, BLOCK, CLASSES = 16, 1_024, 64
#: Distinct sets a task remembers so that it sends equal ones once.
REMEMBERED = 1_000_000
#: Members that are compared with one set in one task; bits of the map of documents whose sets are needed.
SHARE, BITS = 512, 1 << 26
#: Rounds that compare with a neighbour before the exhaustive one.
ROUNDS = 2
#: Pivot documents that are sampled, most characters and least and most shingles of one, rings of distance in a large region.
PIVOT_DOCS, PIVOT_CHARS, PIVOT_LEAST, PIVOT_MOST, RINGS = 1_024, 20_000, 8, 2_048, 32
#: Sets of a region that stay together where regions are joined, about.
SALT = 256
#: The largest two primes below 2 ** 32, a base for each, an odd factor and the multipliers of a 64-bit finaliser.
PRIMES, BASES = (4_294_967_291, 4_294_967_279), (2_654_435_761, 2_246_822_519)
FACTOR, MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


#: Bytes whose words are hashed together.
PIECE = 1 << 19
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


@cache
def powers(prime: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and its inverse modulo the prime, for the places of a piece."""

    def row(b: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < PIECE:
            out = np.concatenate((out, out * np.uint64(pow(b, len(out), prime)) % np.uint64(prime)))
        return out[:PIECE]

    return row(base), row(pow(base, -1, prime))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of lower-case UTF-8 text.

    A word's hash is made of the polynomials of its bytes modulo two primes: each is a difference of running sums,
    exact below 2 ** 64 for a piece, moved to place 0. Pieces end at white space; a word too long for one is hashed
    by itself.
    """
    hashes, starts, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        if end < len(data) and data[end] not in _WHITE:
            cut = max(data.rfind(c, at, end) for c in _SPLITTERS)
            if cut > at:
                end = cut
            elif data[at] in _WHITE:
                end = at + 1
            else:
                stops = [x for c in _SPLITTERS if (x := data.find(c, end)) >= 0]
                end = min(stops, default=len(data))
                hashes.append(np.array([xxhash.xxh3_64_intdigest(data[at:end])], dtype=np.uint64))
                starts.append(np.array([at]))
                at = end
                continue
        codes = np.frombuffer(data, np.uint8, end - at, at)
        space = _SPACE[codes]
        edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True]))))
        first, last = edges[::2], edges[1::2]
        terms, both = codes.astype(np.uint64) + np.uint64(1), np.zeros(len(first), np.uint64)
        for prime, base in zip(PRIMES, BASES, strict=True):
            direct, inverse = powers(prime, base)
            sums = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum(terms * direct[: len(codes)], out=sums[1:])
            both = (both << np.uint64(32)) | ((sums[last] - sums[first]) % np.uint64(prime) * inverse[first] % np.uint64(prime))
        hashes.append(both)
        starts.append(first + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return mixed(np.concatenate(hashes)), np.concatenate(starts)


_SPLITTERS = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
_WHITE = b"".join(_SPLITTERS)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * MIX1
    h = (h ^ (h >> np.uint64(33))) * MIX2
    return h ^ (h >> np.uint64(33))


def chained(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` word hashes."""
    out = np.full(max(0, len(h) - width + 1), np.uint64(width))
    for k in range(width):
        out = out * FACTOR + h[k : k + len(out)]
    return mixed(out)


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; bytes.lower and the splitters touch A-Z and ASCII white space alone.

    Words of all texts are hashed and chained as one array; runs across two texts are never cut out of it.
    """
    parts = [text.encode() for text in texts]
    hashes, starts = word_hashes(b" ".join(parts).lower())
    runs = chained(hashes, SHINGLE)
    ends = np.searchsorted(starts, np.cumsum([len(p) + 1 for p in parts])).tolist()
    out = []
    for start, end in zip([0, *ends], ends, strict=False):
        n = end - start
        members = runs[start : end - SHINGLE + 1].copy() if n >= SHINGLE else chained(hashes[start:end], n) if n else runs[:0]
        members.sort()
        out.append(members[np.concatenate(([True], members[1:] != members[:-1]))] if len(members) > 1 else members)
    return out


def prefix_length(n: int) -> int:
    """Pivots of a set of n members: those a link may lack, and one."""
    return n - -(-3 * n // 4) + 1


def links(common: int, n: int, m: int) -> bool:
    return 7 * common >= 3 * (n + m)


def low_codes(members: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket (by the leading bits) and 32 bits of each of a sorted set's low hashes, as one number."""
    low = members[: np.searchsorted(members, np.uint64(LOW * 2**64))]
    return (((low >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)) << np.uint64(32)) | (low & np.uint64(0xFFFFFFFF))


def set_digest(text: str, members: np.ndarray) -> bytes:
    """128 bits that name a set: of its hashes, or, where one or two shingles are all it has, of their words."""
    if len(members) > 2:
        return xxhash.xxh3_128_digest(members.tobytes())
    words = text.encode().lower().split(None)
    runs = {b" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}
    return xxhash.xxh3_128_digest(b"\n".join(sorted(runs)))


@dataclass(frozen=True)
class Pivots:
    """Sampled documents' sets: their ids and sizes, and the pivots that hold each shingle, by sorted shingle."""

    ids: tuple[int, ...]
    sizes: np.ndarray
    keys: np.ndarray
    starts: np.ndarray
    owners: np.ndarray

    @staticmethod
    def of(sets: list[tuple[int, np.ndarray]]) -> Pivots:
        members = np.concatenate([m for _, m in sets] or [np.zeros(0, np.uint64)])
        owners = np.repeat(np.arange(len(sets)), [len(m) for _, m in sets])
        order = np.argsort(members, kind="stable")
        first, _ = _runs(members[order])
        return Pivots(tuple(i for i, _ in sets), np.array([len(m) for _, m in sets], np.int64), members[order][first], np.append(first, len(members)), owners[order])

    def near(self, sets: list[np.ndarray]) -> list[list[tuple[int, float, bool]]]:
        """Of each set the pivots within 1/2, nearest first: number, distance, and whether they link."""
        out: list[list] = [[] for _ in sets]
        if not len(self.keys) or not sets:
            return out
        members = np.concatenate(sets)
        at = np.minimum(np.searchsorted(self.keys, members), len(self.keys) - 1)
        hits = np.flatnonzero(self.keys[at] == members)
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])[hits]
        at = at[hits]
        first, length = _runs(owner)
        for f, m in zip(first.tolist(), length.tolist(), strict=True):
            own, n = at[f : f + m], len(sets[owner[f]])
            start, count = self.starts[own], self.starts[own + 1] - self.starts[own]
            places = np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())
            common = np.bincount(self.owners[places], minlength=len(self.ids))
            close = np.flatnonzero(3 * common >= n + self.sizes)
            if len(close):
                c, sizes = common[close], self.sizes[close]
                apart = 1 - c / (n + sizes - c)
                order = np.lexsort((close, apart))
                out[owner[f]] = [(int(close[i]), float(apart[i]), bool(7 * c[i] >= 3 * (n + sizes[i]))) for i in order]
        return out


def sampled_pivots(docs: DataFrame) -> Pivots:
    """PIVOT_DOCS documents by hash of their id, less those that link with one taken before; their sets, at most PIVOT_MOST hashes each, are made by tasks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(texts_of(batch))
            fit = pa.array([PIVOT_LEAST <= len(m) <= PIVOT_MOST for m in sets], pa.bool_())
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array([m.tobytes() for m in sets], pa.binary())], names=["doc_id", "members"]).filter(fit)

    fit = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= PIVOT_CHARS))
    sample = hash_sample(fit.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id", PIVOT_DOCS)
    found = sample.mapInArrow(read, "doc_id long, members binary").toArrow()
    sets = [(i, np.frombuffer(m, np.uint64)) for i, m in zip(found.column("doc_id").to_pylist(), found.column("members").to_pylist(), strict=True)]
    all_of_them = Pivots.of(sets)
    kept, taken = set(), []
    for i, (_, members) in enumerate(sets):
        if not any(linked and j in kept for j, _, linked in all_of_them.near([members])[0]):
            kept.add(i)
            taken.append(sets[i])
    return Pivots.of(taken)


def survey(docs: DataFrame, pivots: Broadcast, buckets: int) -> DataFrame:
    """One row a document (doc_id, n, set_hash, near: the pivots near it), and rows (bucket, keys) with the low hashes of all distinct sets of a task that no pivot links with."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        held, size, seen = [], 0, set()

        def low() -> pa.RecordBatch:
            codes = np.sort(np.concatenate(held))
            ends = np.searchsorted(codes, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
            filled = [b for b in range(buckets) if ends[b] < ends[b + 1]]
            keys = [(codes[ends[b] : ends[b + 1]] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() for b in filled]
            n = len(filled)
            return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, near_type), pa.array(filled, pa.int32()), pa.array(keys, pa.binary())], names=names)

        for batch in slices(batches):
            texts = texts_of(batch)
            sets = shingle_sets(texts)
            digests = [set_digest(t, s) for t, s in zip(texts, sets, strict=True)]
            near, none = pivots.value.near(sets), len(sets)
            listed = pa.array([[{"pivot": p, "apart": d, "linked": x} for p, d, x in close] or None for close in near], near_type)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), listed, pa.nulls(none, pa.int32()), pa.nulls(none, pa.binary())], names=names)
            for members, digest, close in zip(sets, digests, near, strict=True):
                if len(members) > 2 and digest not in seen and not (close and close[0][2]):
                    if len(seen) < REMEMBERED:
                        seen.add(digest)
                    held.append(low_codes(members, buckets))
                    size += len(held[-1])
            if size >= COUNTED:
                yield low()
                held, size = [], 0
        if size:
            yield low()

    names = ["doc_id", "n", "set_hash", "near", "bucket", "keys"]
    near_type = pa.list_(pa.struct([("pivot", pa.int32()), ("apart", pa.float64()), ("linked", pa.bool_())]))
    return docs.select("doc_id", "text").mapInArrow(read, "doc_id long, n long, set_hash binary, near array<struct<pivot: int, apart: double, linked: boolean>>, bucket int, keys binary")


def common_shingles(surveyed: DataFrame) -> np.ndarray:
    """Sorted codes of the commonest low shingles, at most MOST_COMMON; which ones affects speed alone."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, keys = 0, []
        for batch in batches:
            bucket = column(batch, "bucket")[0].as_py() if batch.num_rows else bucket
            keys += [np.frombuffer(blob, np.uint32) for blob in column(batch, "keys").to_pylist()]
        ordered_keys = np.sort(np.concatenate(keys))
        first, times = _runs(ordered_keys)
        often = times >= COMMON
        codes = (np.int64(bucket) << np.int64(32)) | ordered_keys[first[often]].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(times[often].astype(np.int64))], names=["code", "times"])

    counted = surveyed.where("keys is not null").select("bucket", "keys").groupBy("bucket").applyInArrow(count, "code long, times long")
    top = counted.orderBy(F.desc("times"), "code").limit(MOST_COMMON).select("code").toArrow()
    return np.sort(top.column("code").to_numpy().astype(np.uint64))


def ordered(members: np.ndarray, common: np.ndarray, buckets: int) -> np.ndarray:
    """A set's members as pivots in order: by hash, common ones last."""
    if not len(common):
        return members
    codes = low_codes(members, buckets)
    at = np.minimum(np.searchsorted(common, codes), len(common) - 1)
    late = np.zeros(len(members), bool)
    late[: len(codes)] = common[at] == codes
    return np.concatenate((members[~late], members[late])) if late.any() else members


def windows(docs: DataFrame, near: Broadcast, common: Broadcast, buckets: int) -> DataFrame:
    """(bucket, pivots): each task's copies of documents that no sampled pivot links with into regions of shingles, dealt to buckets by hash.

    The binary holds, for a number of copies, pivot hashes (u64), set numbers (u32), then ids (i64) and sizes (u32) of
    the sets: packed, since a row for each copy would cost several times as much to shuffle.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        seen = set()
        pivots, ids, sizes, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            pivot = np.concatenate(pivots)
            number = np.repeat(np.arange(len(pivots), dtype=np.uint32), [len(p) for p in pivots])
            bucket = ((pivot >> np.uint64(16)) % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            all_ids, all_sizes = np.array(ids, dtype=np.int64), np.array(sizes, dtype=np.uint32)
            filled = [b for b in range(buckets) if ends[b] < ends[b + 1]]
            blobs = []
            for b in filled:
                own = order[ends[b] : ends[b + 1]]
                # The order is stable, so a bucket's copies come set by set.
                first, length = _runs(number[own])
                sets, number_here = number[own[first]], np.repeat(np.arange(len(first), dtype=np.uint32), length)
                blobs.append(np.array([len(own), len(sets)], dtype=np.int64).tobytes() + pivot[own].tobytes() + number_here.tobytes() + all_ids[sets].tobytes() + all_sizes[sets].tobytes())
            pivots.clear(), ids.clear(), sizes.clear()
            return pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "pivots"])

        for batch in slices(batches):
            sets = shingle_sets(texts_of(batch))
            for doc_id, members, close in zip(column(batch, "doc_id").to_pylist(), sets, near.value.near(sets), strict=True):
                key = xxhash.xxh3_128_digest(members.tobytes())
                if doc_id is None or len(members) <= 2 or key in seen or close and close[0][2]:
                    continue
                if len(seen) < REMEMBERED:
                    seen.add(key)
                window = ordered(members, common.value, buckets)[: prefix_length(len(members))]
                pivots.append(window)
                ids.append(doc_id)
                sizes.append(len(members))
                held += len(window)
                if held >= PIVOTS:
                    yield flush()
                    held = 0
        if pivots:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(read, "bucket int, pivots binary")


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    copies, sets = np.frombuffer(blob, np.int64, 2)
    pivot = np.frombuffer(blob, np.uint64, copies, 16)
    number = np.frombuffer(blob, np.uint32, copies, 16 + 8 * copies)
    ids = np.frombuffer(blob, np.int64, sets, 16 + 12 * copies)
    sizes = np.frombuffer(blob, np.uint32, sets, 16 + 12 * copies + 8 * sets)
    return pivot, ids[number], sizes[number].astype(np.int64)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position and length of each run of equal keys."""
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(keys)))


def regions(windowed: DataFrame) -> DataFrame:
    """(region, id, n, center, first, size) of every copy in a region of two sets or more.

    center: the smallest set within reach of its size; first: the region's smallest id; size: its number of sets.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts = 0, []
        for batch in batches:
            bucket = column(batch, "bucket")[0].as_py() if batch.num_rows else bucket
            parts += [unpack(blob) for blob in column(batch, "pivots").to_pylist()]
        pivot, ids, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((ids, n, pivot))
        pivot, ids, n = pivot[order], ids[order], n[order]
        first, length = _runs(pivot)
        many = np.repeat(length > 1, length)
        pivot, ids, n = pivot[many], ids[many], n[many]
        if not len(ids):
            return
        first, length = _runs(pivot)
        # Within a region, sizes rise: a run starts anew wherever its first size no longer reaches the next one.
        center = np.empty(len(ids), np.int64)
        start = first.copy()
        end = first + length
        while len(start):
            at = np.repeat(start, end - start)
            rows = np.arange(len(at)) - np.repeat(np.cumsum(end - start) - (end - start), end - start) + at
            reach = 3 * n[rows] <= 4 * n[at]
            center[rows[reach]] = ids[at[reach]]
            reached = np.add.reduceat(reach.astype(np.int64), np.cumsum(end - start) - (end - start))
            start = start + reached
            left = start < end
            start, end = start[left], end[left]
        least, sizes = np.repeat(np.minimum.reduceat(ids, first), length), np.repeat(length, length).astype(np.int32)
        # Numbers of regions within their bucket take fewer bytes than the pivots' hashes wherever rows are shuffled or kept.
        region = (np.int64(bucket) << np.int64(32)) | np.repeat(np.arange(len(first)), length)
        for at in range(0, len(ids), 100_000):
            cut = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(x[cut]) for x in (region, ids, n.astype(np.int32), center, least, sizes)], names=["region", "id", "n", "center", "first", "size"])

    return windowed.groupBy("bucket").applyInArrow(build, "region long, id long, n int, center long, first long, size int")


def _bitmap(ids: DataFrame) -> np.ndarray:
    """BITS bits, one for the hash of each id; collected as words, so its size does not depend on the ids' number."""
    slot = F.pmod(F.xxhash64("id"), F.lit(BITS))
    words = ids.select(F.floor(slot / 32).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(id), {BITS}) % 32 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(BITS // 32, dtype=np.uint32)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy().astype(np.uint32)
    return out


def sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, members) of the documents in ids, and of a few others whose hash has the same bit."""
    bits = docs.sparkSession.sparkContext.broadcast(_bitmap(ids))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            slot = column(batch, "slot").to_numpy()
            batch = batch.filter(pa.array((bits.value[slot // 32] >> (slot % 32).astype(np.uint32)) & 1 == 1))
            sets = shingle_sets(texts_of(batch))
            filled = pa.array([len(s) > 0 for s in sets], pa.bool_())
            yield pa.RecordBatch.from_arrays([column(batch, "id"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "members"]).filter(filled)

    keyed = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), "text").withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(BITS)))
    return keyed.mapInArrow(read, "id long, members binary")


def compare(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, compared on their whole sets; pairs must be a written table.

    The members to be compared with one set go to tasks in shares of SHARE, each of which gets a copy of that set.
    """
    shares = pairs.groupBy("a").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("shares"))
    members = pairs.join(shares, "a").select(F.col("b").alias("id"), "a", F.pmod(F.xxhash64("b"), F.col("shares")).cast("int").alias("share"))
    centers = shares.select(F.col("a").alias("id"), "a", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    sent = members.union(centers)
    dealt = sent.join(sets_of(docs, sent.select("id")), "id").withColumn("member", F.col("id") != F.col("a"))
    # Without a number of partitions, so that adaptive execution joins small ones: late rounds have few pairs.
    grouped = dealt.repartition("a", "share").sortWithinPartitions("a", "share", "member")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            found = []
            for a, share, member, b, data in zip(*(column(batch, c).to_pylist() for c in ("a", "share", "member", "id", "members")), strict=True):
                members = np.frombuffer(data, np.uint64)
                if key != (a, share):
                    key, held = (a, share), []
                if not member:
                    held.append(members)
                    continue
                for center in held:
                    at = np.minimum(np.searchsorted(center, members), len(center) - 1)
                    if links(int((center[at] == members).sum()), len(center), len(members)):
                        found.append((a, b))
                        break
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], names=["a", "b"])

    return grouped.select("a", "share", "member", "id", "members").mapInArrow(check, "a long, b long")


def with_labels(rows: DataFrame, labels: DataFrame, key: str, name: str) -> DataFrame:
    """rows with the component of their key as `name`; a node without links is its own component."""
    return rows.join(labels.select(F.col("node").alias(key), F.col("root").alias(name)), key, "left").withColumn(name, F.coalesce(name, key))


def star_pairs(table: DataFrame, labels: DataFrame) -> DataFrame:
    """Of every set the two centers that it meets most often, if in a quarter of its window at least, and not yet in its component."""
    met = table.where("id != center").groupBy("id", "center").agg(F.count("*").alias("met"), F.min("n").alias("n"))
    often = met.where(F.col("met") * 16 >= F.col("n"))
    best = often.withColumn("nth", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("met"), "center"))).where("nth <= 2")
    return with_labels(with_labels(best, labels, "id", "x"), labels, "center", "y").where("x != y").select(F.col("center").alias("a"), F.col("id").alias("b"))


def _crossing(table: DataFrame, labels: DataFrame, neighbours: bool) -> DataFrame:
    """(a, b, met): pairs of regions whose components differ, with the number of regions they share.

    neighbours: only each member and the next one in size of another component; else all pairs that sizes allow.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = [[column(batch, c).to_numpy() for c in ("region", "id", "n", "label")] for batch in batches]
        region, ids, n, label = (np.concatenate(x).astype(np.int64) for x in zip(*whole, strict=True))
        order = np.lexsort((ids, n, region))
        region, ids, n, label = region[order], ids[order], n[order], label[order]
        counts: dict[str, list] = {"a": [], "b": [], "n": [], "m": []}

        def add(i: np.ndarray, j: np.ndarray) -> None:
            keep = (label[i] != label[j]) & (3 * n[j] <= 4 * n[i])
            i, j = i[keep], j[keep]
            swap = ids[i] > ids[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            for name, values in (("a", ids[i]), ("b", ids[j]), ("n", n[i]), ("m", n[j])):
                counts[name].append(values)

        first, length = _runs(region)
        if neighbours:
            # The next member of another component: the first one after the run of members of the same component.
            same = np.flatnonzero(np.concatenate(([True], (region[1:] != region[:-1]) | (label[1:] != label[:-1]))))
            after = np.repeat(np.append(same[1:], len(ids)), np.diff(np.append(same, len(ids))))
            i = np.flatnonzero(after < np.repeat(first + length, length))
            add(i, after[i])
        else:
            low = np.minimum.reduceat(label, first)
            high = np.maximum.reduceat(label, first)
            for f, m in zip(first[low != high], length[low != high], strict=True):
                for i in range(f, f + m - 1):
                    j = np.arange(i + 1, min(f + m, i + 1 + np.searchsorted(n[i + 1 : f + m], 4 * n[i] // 3, side="right")))
                    if len(j):
                        add(np.full(len(j), i), j)
        if not counts["a"]:
            return
        a, b, x, y = (np.concatenate(counts[c]) for c in ("a", "b", "n", "m"))
        order = np.lexsort((b, a))
        a, b, x, y = a[order], b[order], x[order], y[order]
        start = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))) if len(a) else np.zeros(0, np.int64)
        met = np.diff(np.append(start, len(a)))
        for at in range(0, len(start), 100_000):
            cut = start[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (a[cut], b[cut], x[cut], y[cut], met[at : at + 100_000])], names=["a", "b", "n", "m", "met"])

    # A region of very many sets is dealt to shares of about SALT, each with neighbours of its own; all pairs need it whole.
    share = F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / SALT)).cast("int") if neighbours else F.lit(0)
    labelled = with_labels(table.select("region", "id", "n", "size"), labels, "id", "label").select("region", "id", "n", "label", F.shiftright("region", 32).cast("int").alias("bucket"), share.alias("share"))
    found = labelled.groupBy("bucket", "share").applyInArrow(pairs, "a long, b long, n long, m long, met long")
    return found.groupBy("a", "b").agg(F.min("n").alias("n"), F.min("m").alias("m"), F.sum("met").alias("met"))


def signature(members: np.ndarray) -> np.ndarray:
    """Members in each class of shingles."""
    return np.bincount((members & np.uint64(CLASSES - 1)).astype(np.int64), minlength=CLASSES)


def families(large: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, n, label, family, block, whole) of the sets of large regions that lie in several components.

    Sets are dealt to blocks of about BLOCK of a family: a component that fills blocks has blocks of its own
    (`whole` names it), the others share some.
    """
    rows = with_labels(large.select("region", "id", "n", "first", "size"), labels, "id", "label")
    mixed = rows.groupBy("region").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max("size").alias("size")).where("low <> high")
    # A region of a very common line is dealt to shares of about SALT sets.
    shares = F.ceil(F.col("size") / SALT).cast("int")
    salted = mixed.select("region", F.explode(F.sequence(F.lit(0), shares - 1)).alias("share"))
    dealt = rows.withColumn("share", F.pmod(F.xxhash64("id"), shares).cast("int"))
    rows = materialize(dealt.join(salted, ["region", "share"]).select("id", "n", "first", "label").distinct(), "families")
    roots = components(rows.select(F.col("id").alias("u"), F.col("first").alias("v")))
    members = rows.select("id", "n", "label").distinct().join(roots.select(F.col("node").alias("id"), F.col("root").alias("family")), "id")
    per_label = members.groupBy("family", "label").agg(F.count("*").alias("k"))
    rest = per_label.where(F.col("k") < BLOCK).groupBy("family").agg(F.sum("k").alias("few"))
    own, shared = F.ceil(F.col("k") / BLOCK), F.ceil(F.coalesce("few", F.lit(1)) / BLOCK)
    filled = F.col("k") >= BLOCK
    block = F.when(filled, F.xxhash64("label", F.pmod(F.xxhash64("id"), own))).otherwise(F.pmod(F.xxhash64("label"), shared))
    placed = members.join(per_label, ["family", "label"]).join(rest, "family", "left")
    return placed.select("id", "n", "label", "family", block.alias("block"), F.when(filled, F.col("label")).alias("whole"))


def family_links(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b) of links between components in families: enough of them to join all components that any link joins."""
    blocks = members.groupBy("family", "block").agg(F.min("whole").alias("whole"), F.min("n").alias("low"), F.max("n").alias("high"))
    other = blocks.select("family", F.col("block").alias("block2"), F.col("whole").alias("whole2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    near = (F.col("low") * 3 <= F.col("high2") * 4) & (F.col("low2") * 3 <= F.col("high") * 4)
    pairs = blocks.join(other, "family").where((F.col("block") <= F.col("block2")) & near & ~F.coalesce(F.col("whole") == F.col("whole2"), F.lit(False)))
    key = F.xxhash64("family", "block", "block2")
    sides = pairs.select("family", "block", key.alias("pair"), F.lit(0).alias("side")).union(pairs.where("block <> block2").select("family", F.col("block2"), key, F.lit(1)))
    return paired_links(docs, members.join(sides, ["family", "block"]).select("id", "label", "pair", "side"))


def paired_links(docs: DataFrame, sent: DataFrame) -> DataFrame:
    """(a, b) of links between the sides of each pair of blocks, or within a block of one side, that join its components."""
    dealt = sent.join(sets_of(docs, sent.select("id").distinct()), "id")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            found = []
            for pair, side, label, id_, data in zip(*(column(batch, c).to_pylist() for c in ("pair", "side", "label", "id", "members")), strict=True):
                if pair != key:
                    found += _block_links(held)
                    key, held = pair, []
                held.append((side, label, id_, np.frombuffer(data, np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], names=["a", "b"])
        found = _block_links(held)
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], names=["a", "b"])

    grouped = dealt.repartition(parts, "pair").sortWithinPartitions("pair", "side")
    return grouped.select("pair", "side", "label", "id", "members").mapInArrow(check, "a long, b long")


def region_rows(info: DataFrame) -> DataFrame:
    """(id, n, region, apart, inside) of each distinct set in the regions of sampled pivots: its own, or as one of their boundary."""
    distinct = info.where("near is not null and doc_id is not null").groupBy("set_hash").agg(F.min(F.struct("doc_id", "n", "near")).alias("one"))
    each = distinct.select(F.col("one.doc_id").alias("id"), F.col("one.n").alias("n"), F.posexplode("one.near").alias("nth", "pivot"))
    return each.select("id", "n", F.col("pivot.pivot").alias("region"), F.col("pivot.apart").alias("apart"), (F.col("pivot.linked") & (F.col("nth") == 0)).alias("inside"))


def boundary_links(docs: DataFrame, rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b) of links between members of a sampled pivot's region and its boundary, as many as join components.

    A side of more than BLOCK sets is dealt to blocks by ring of distance to the pivot; blocks that the triangle
    inequality keeps apart do not meet, nor do the members among themselves, who all link with the pivot.
    """
    labelled = with_labels(rows, labels, "id", "label")
    own = labelled.where("inside").groupBy("region").agg(F.min("label").alias("own"))
    # One row a pivot and side: PIVOT_DOCS bounds what is broadcast here.
    placed = materialize(labelled.join(sized(own, "components of pivots", PIVOT_DOCS, 16), "region").where("inside or label <> own").select("region", "inside", "id", "label", "apart"), "boundary")
    sides = placed.groupBy("region", "inside").agg(F.count("*").alias("many"))
    met = sides.groupBy("region").agg(F.count("*").alias("k")).where("k = 2").select("region")
    ring = F.floor(F.col("apart") * RINGS).cast("long") * F.lit(1 << 32) + F.pmod(F.xxhash64("id"), F.ceil(F.col("many") / BLOCK))
    many = sized(sides.join(met, "region"), "sides of pivots", 2 * PIVOT_DOCS, 24)
    dealt = materialize(placed.join(many, ["region", "inside"]).withColumn("block", F.when(F.col("many") > BLOCK, ring).otherwise(F.lit(-1).cast("long"))).drop("many"), "boundary")
    blocks = dealt.groupBy("region", "inside", "block").agg(F.min("apart").alias("low"), F.max("apart").alias("high"))
    left = blocks.where("inside").select("region", F.col("block").alias("b0"), "high")
    right = blocks.where("not inside").select("region", F.col("block").alias("b1"), "low")
    pairs = materialize(left.join(right, "region").where(F.col("high") >= F.col("low") - 0.250001).withColumn("pair", F.xxhash64("region", "b0", "b1")), "boundary")
    first = pairs.select("region", F.lit(True).alias("inside"), F.col("b0").alias("block"), "pair")
    second = pairs.select("region", F.lit(False), "b1", "pair")
    sent = dealt.join(first.union(second), ["region", "inside", "block"]).select("id", "label", "pair", F.when(F.col("inside"), 0).otherwise(1).alias("side"))
    return paired_links(docs, materialize(sent, "boundary"))


def _block_links(rows: list[tuple[int, int, int, np.ndarray]]) -> list[tuple[int, int]]:
    """Links between two blocks, or within one, that join components not yet joined."""
    if len(rows) < 2:
        return []
    root = {label: label for _, label, _, _ in rows}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    n = np.array([len(r[3]) for r in rows])
    counts = np.stack([signature(r[3]) for r in rows]).astype(np.int32)
    side = np.array([r[0] for r in rows])
    two = bool(side.any())
    out = []
    for i, (own_side, label, id_, members) in enumerate(rows):
        if two and own_side:
            break
        later = np.flatnonzero(side == 1) if two else np.arange(i + 1, len(rows))
        if not len(later):
            break
        apart = np.abs(counts[later] - counts[i]).sum(axis=1)
        for j in later[7 * apart <= n[later] + n[i]]:
            other = rows[j]
            if find(label) == find(other[1]):
                continue
            at = np.minimum(np.searchsorted(members, other[3]), len(members) - 1)
            if links(int((members[at] == other[3]).sum()), n[i], n[j]):
                root[find(label)] = find(other[1])
                out.append((min(id_, other[2]), max(id_, other[2])))
    return out


def rest_of(n: Column) -> Column:
    """Members of a set of n outside its window."""
    return F.ceil(n * 3 / 4) - 1


def linked_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    spark = docs.sparkSession
    docs = small_batches(docs).select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    pivots = sampled_pivots(docs)
    near = spark.sparkContext.broadcast(pivots)
    surveyed = materialize(survey(docs, near, buckets), "survey")
    info = materialize(surveyed.where("set_hash is not null").select("doc_id", "n", "set_hash", "near"), "sets")
    common = spark.sparkContext.broadcast(common_shingles(surveyed))
    discard(surveyed)
    filled = info.where("doc_id is not null and n > 0")
    least = filled.groupBy("set_hash").agg(F.min("doc_id").alias("v"), F.count("*").alias("copies")).where("copies > 1").select("set_hash", "v")
    equal = filled.join(least, "set_hash").select(F.col("doc_id").alias("u"), "v").where("u != v")
    # The members of a sampled pivot's region, each linked with it.
    in_regions = materialize(region_rows(info), "regions-of-pivots")
    pivot_ids = F.array(*map(F.lit, pivots.ids)) if pivots.ids else F.array(F.lit(0))
    to_pivots = in_regions.where("inside").select(F.col("id").alias("u"), F.element_at(pivot_ids, F.col("region") + 1).cast("long").alias("v"))
    copies = materialize(equal.union(to_pivots), "links")
    table = materialize(regions(windows(docs, near, common, buckets)), "regions")
    labels = components(copies)

    def merge(pairs: DataFrame) -> bool:
        pairs = materialize(pairs.select("a", "b"), "pairs")
        return not pairs.isEmpty() and join(compare(docs, pairs))

    def join(found: DataFrame) -> bool:
        nonlocal labels
        found = materialize(found.select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
        if found.isEmpty():
            return False
        labels = components(labels.select(F.col("node").alias("u"), F.col("root").alias("v")).union(found))
        return True

    join(boundary_links(docs, in_regions, labels))
    merge(star_pairs(table, labels))
    large = table.where(F.col("size") >= LARGE)
    for _ in range(ROUNDS):
        near = _crossing(large, labels, neighbours=True).where(F.col("met") * 16 >= F.least("n", "m"))
        best = near.withColumn("nth", F.row_number().over(Window.partitionBy("b").orderBy(F.desc("met"), "a"))).where("nth <= 2")
        if not merge(best):
            break
    overlap = F.ceil((F.col("n") + F.col("m")) * 3 / 7)
    possible = F.col("met") >= overlap - F.greatest(rest_of(F.col("n")), rest_of(F.col("m")))
    join(family_links(docs, materialize(families(large, labels), "members")))
    # Pairs that share a large region were in a family; for all others `met` counts every region they share.
    merge(_crossing(table.where(F.col("size") < LARGE), labels, neighbours=False).where(possible))
    return info.join(labels.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left").select(F.col("doc_id").cast(kind), F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").cast(kind).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs without those whose component has a smaller doc_id, with all their columns; rows of null doc_id stay.

    Of rows that repeat a doc_id all stay if that id does.
    """
    rest = linked_components(docs).where("doc_id != component_id").select("doc_id").distinct()
    return docs.join(rest, "doc_id", "left_anti").select(*docs.columns)


#: DuckDB SQL for linked_components: an inverted-index join, then the least document reachable by links.
JACCARD_SQL = r"""
    with recursive w as materialized (
        select doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
        from documents),
    s as materialized (
        select distinct doc_id, unnest(case when len(words) = 0 then []
            when len(words) < 5 then [array_to_string(words, ' ')]
            else list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) end) as sh
        from w),
    n as materialized (select doc_id, count(*) as n from s group by doc_id),
    e as materialized (
        select a.doc_id as u, b.doc_id as v
        from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id
        join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
        group by a.doc_id, b.doc_id, x.n, y.n
        having 100 * count(*) >= 75 * (x.n + y.n - count(*))),
    r(node, seen) as (
        select u, v from e union select v, u from e
        union
        select r.node, case when e.u = r.seen then e.v else e.u end from r join e on r.seen in (e.u, e.v))
    select w.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles,
           least(w.doc_id, coalesce(min(r.seen), w.doc_id)) as component_id
    from w left join n on n.doc_id = w.doc_id left join r on r.node = w.doc_id
    group by w.doc_id, n.n"""
