"""Operators 5, 6, 7 and 9 against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from driftfold.llm import ann, components, decontam, jaccard, sharding

WORDS = [a + b for a in "ba ko ri mu te so".split() for b in "n l s x d".split()]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(WORDS) + "q"
    return " ".join(words)


# ---------------------------------------------------------------- Jaccard


def sets_of(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_components(rows):
    sets = defaultdict(list)
    for d, t in rows:
        sets[d].append(sets_of(t))
    ids = sorted(d for d in sets if d is not None)
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: find(d) for d in ids}


@pytest.fixture(scope="module")
def copies():
    """Groups of near copies and chains of them, texts under one common passage, exact copies, odd ones."""
    rng = random.Random(3)
    rows, passage = [], prose(rng, 50)
    for group, (size, length, edits) in enumerate([(60, 120, 2), (40, 60, 1), (30, 300, 9), (5, 20, 1), (25, 80, 4)]):
        text = base = prose(rng, length)
        for i in range(size):
            rows.append(text)
            text = edited(rng, base if group % 2 else text, rng.randint(0, edits))
    rows += [passage + " " + prose(rng, rng.randint(1, 60)) for _ in range(60)]
    rows += [rows[0]] * 30 + [None, "", " ", "one two", "One  TWO", "one two three four", "a b c d e", "A b c d e f"] + [prose(rng, rng.randint(1, 200)) for _ in range(60)]
    rng.shuffle(rows)
    return [*enumerate(rows), (None, rows[0]), (5, rows[7]), (5, prose(rng, 30))]


@pytest.mark.parametrize("limits", [{}, {"COMMON": 3, "LARGE": 4, "BLOCK": 8, "SHARE": 3, "PIVOTS": 500, "COUNTED": 500, "REMEMBERED": 5}, {"COMMON": 10**9, "LARGE": 10**9}, {"MOST_COMMON": 1, "LARGE": 2, "BLOCK": 5, "ROUNDS": 0}, {"PIVOT_DOCS": 0}, {"PIVOT_DOCS": 12, "BLOCK": 3, "SALT": 3}, {"PIVOT_DOCS": 5, "PIVOT_LEAST": 1, "LARGE": 10**9}])
def test_components_are_exact(spark, copies, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(jaccard, name, value)
    docs = spark.createDataFrame(copies, "doc_id long, text string")
    want = plain_components(copies)
    got = jaccard.linked_components(docs).collect()
    assert len(got) == len(copies)
    for r in got:
        assert r.component_id == want.get(r.doc_id), r.doc_id
    assert sorted(r.n_shingles for r in got) == sorted(len(sets_of(t)) for _, t in copies)


def test_one_of_each_group_stays(spark, copies):
    docs = spark.createDataFrame([(d, t, "x") for d, t in copies], "doc_id long, text string, component_id string")
    want = plain_components(copies)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(d) for d, _ in copies if d is None or want[d] == d)
    assert jaccard.linked_components(docs.limit(0)).count() == 0


def test_sets_of_texts_are_their_shingles(monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(jaccard, "PIECE", 64)
    jaccard.powers.cache_clear()
    texts = ["", " ", "a", "x" * 500, "x" * 500 + " y", " lead", "trail ", "a\tb\x0bc\x0cd\re", "É é", "é É é É é É", "a\u0085b c\u00a0d\x1ce f g h"] + [prose(rng, rng.randint(0, 80)) for _ in range(80)]
    texts += [" ".join("z" * rng.randint(1, 90) for _ in range(12)) for _ in range(20)]
    got = jaccard.shingle_sets(texts)
    jaccard.powers.cache_clear()
    seen = {}
    for text, members in zip(texts, got, strict=True):
        assert len(members) == len(sets_of(text)) and (np.diff(members.astype(object)) > 0).all()
        assert seen.setdefault(frozenset(sets_of(text)), members.tolist()) == members.tolist()
    for i, a in enumerate(texts):
        for j in range(i):
            assert len(np.intersect1d(got[i], got[j])) == len(sets_of(a) & sets_of(texts[j]))


def test_words_of_one_sum_are_told_apart(spark):
    """The Thue-Morse word and its complement, which meet in any polynomial modulo a power of two."""
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    one, other = ("".join("ab"[x ^ flip] for x in bits) for flip in (0, 1))
    a, b = jaccard.shingle_sets([one, other])
    assert a[0] != b[0]
    rows = [(1, one), (2, other), (3, one.upper()), (4, f"{one} a b c d e f g"), (5, f"{other} a b c d e f g")]
    got = {r.doc_id: r.component_id for r in jaccard.linked_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def test_few_shingles_link_with_equal_sets_alone():
    pairs = [(n, m) for n in (1, 2) for m in range(1, 9) for c in range(1, min(n, m) + 1) if jaccard.links(c, n, m)]
    assert pairs == [(1, 1), (2, 2)]


def test_distances_to_pivots_are_jaccards():
    rng = random.Random(4)
    base = [prose(rng, rng.randint(12, 60)) for _ in range(12)]
    texts = [edited(rng, rng.choice(base), rng.randint(0, 6)) for _ in range(120)]
    pivots = jaccard.Pivots.of([*enumerate(jaccard.shingle_sets(base))])
    for text, close in zip(texts, pivots.near(jaccard.shingle_sets(texts)), strict=True):
        own = sets_of(text)
        want = {i: 1 - len(own & p) / len(own | p) for i, p in enumerate(map(sets_of, base))}
        assert {i: d for i, d, _ in close} == pytest.approx({i: d for i, d in want.items() if d <= 0.5})
        assert all(linked == (100 * len(own & sets_of(base[i])) >= 75 * len(own | sets_of(base[i]))) for i, _, linked in close)
        assert [d for _, d, _ in close] == sorted(d for _, d, _ in close)


def test_window_bound_holds():
    for n in range(1, 400):
        assert jaccard.prefix_length(n) == n - math.ceil(0.75 * n) + 1


@pytest.mark.parametrize("local", [0, 10**6])
def test_components_of_chains_and_stars(spark, monkeypatch, local):
    monkeypatch.setattr(components, "LOCAL", local)
    edges = [(i, i + 1) for i in range(0, 50)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200), (140, 60), (60, 50)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in [*range(51), 60, 140]} == {0} and {got[i] for i in range(100, 140)} == {100} and got[201] == 200
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# ---------------------------------------------------------------- decontamination


def brute_hits(items, text):
    """{item_id: (score, overlap)}: every item compared with every passage that could hold it, by the formulas alone.

    A passage is 128 * 2 ** k words for items of at most 32 * 2 ** k, half overlapping. An item is found where 3/4 of its
    shingles, 3/5 of those of its first 3/4 words, and 3/5 of its other words are in one passage. Its score is BM25
    (k1 = 1.2, b = 0.75) over what BM25 gives at the least to a passage that holds 3/4 of its shingles.
    """
    def split(t):
        return re.findall(r"\w+", t.lower())

    def grams(w):
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    bench = [(i, split(t)) for i, t in items if t and split(t)]
    mean = sum(len(w) for _, w in bench) / max(1, len(bench))
    holders = Counter(t for _, w in bench for t in set(w))
    words, found = split(text), {}
    for i, w in bench:
        longest = 32
        while longest < len(w):
            longest *= 2
        weight = {t: math.log(1 + (len(bench) - holders[t] + 0.5) / (holders[t] + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(w) / mean)) for t, f in Counter(w).items()}
        own = grams(w)
        missing = len(own) - math.ceil(0.75 * len(own))
        least = sum(sorted(weight.values())[: max(1, len(weight) - missing)])
        for at in range(0, max(1, len(words) - 2 * longest), 2 * longest):
            passage = words[at : at + 4 * longest]
            if len(w) < 5:
                overlap = float(any(passage[k : k + len(w)] == w for k in range(len(passage) - len(w) + 1)))
                good = overlap == 1
            else:
                held, cut = grams(passage) if len(passage) >= 5 else set(), max(5, len(w) * 3 // 4)
                overlap = len(own & held) / len(own)
                asked, answer = grams(w[:cut]), Counter(w[cut:])
                good = overlap >= 0.75 and len(asked & held) >= 0.6 * len(asked) and (not answer or (answer & Counter(passage)).total() >= 0.6 * answer.total())
            if good and (i not in found or found[i][1] < overlap):
                found[i] = (sum(weight[t] for t in set(w) & set(passage)) / least, overlap)
    return found


@pytest.mark.parametrize("block", [4_096, 7])
def test_wand_finds_all_that_verify(spark, monkeypatch, block):
    rng = random.Random(5)
    items = [(i, prose(rng, rng.choice([3, 8, 30, 45, 90]))) for i in range(60)]
    texts = []
    for i in range(120):
        item = rng.choice(items)[1]
        inside = rng.choice([item, edited(rng, item, 1), item.upper().replace(" ", ", "), " ".join(item.split()[: len(item.split()) // 2]), ""])
        texts.append(" ".join([prose(rng, rng.randint(0, 300)), inside, prose(rng, rng.randint(0, 300))]))
    docs = spark.createDataFrame([*enumerate(texts), (500, None), (501, ""), (None, items[3][1])], "doc_id long, text string")
    bench = spark.createDataFrame([*items, (99, None), (98, "...")], "item_id long, text string")
    want = {d: hits for d, t in enumerate(texts) if (hits := brute_hits(items, t))}
    # One block of items or many: the statistics, and so the scores, are the whole benchmark's.
    monkeypatch.setattr(decontam, "ITEM_BLOCK", block)
    got = defaultdict(dict)
    for r in decontam.find_contamination(docs, bench).collect():
        got[r.doc_id][r.item_id] = (r.score, r.overlap)
    assert {d: set(s) for d, s in got.items() if d is not None} == {d: set(s) for d, s in want.items()} and got[None] and len(want) > 50
    for d, hits in want.items():
        for i, (score, overlap) in hits.items():
            assert got[d][i] == pytest.approx((score, overlap), rel=1e-6) and score >= 0.999
    kept = {r.doc_id for r in decontam.clean_documents(docs, bench).collect()}
    assert kept == {*range(120), 500, 501} - want.keys()


def test_decontamination_keeps_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h", 0.5, 7), (2, "nothing of it", 0.1, 8)], "doc_id long, text string, score double, item_id int")
    bench = spark.createDataFrame([(3, "a b c d e f g h")], "item_id long, text string")
    assert [tuple(r) for r in decontam.clean_documents(docs, bench).collect()] == [(2, "nothing of it", 0.1, 8)]
    assert [(r.doc_id, r.item_id) for r in decontam.find_contamination(docs, bench).collect()] == [(1, 3)]


def test_exact_copies_of_short_items_are_found():
    rng = random.Random(11)
    items = []
    for i in range(400):
        own = [f"{rng.choice(WORDS)}{i}{x}" for x in "abcd"[: rng.randint(2, 4)]]
        items.append((i, " ".join(own + rng.choices(own, k=rng.randint(2, 7 - len(own))))))
    bench = decontam.Benchmark(items)
    missed = [text for (i, text), hits in zip(items, bench.hits([t for _, t in items]), strict=True) if i not in {h.item_id for h in hits.values()}]
    assert not missed


@pytest.mark.parametrize("length, more", [(28, 12), (32, 20), (30, 30), (32, 32), (62, 30), (64, 64)])
def test_copies_with_words_put_in_are_found_at_all_positions(length, more):
    rng = random.Random(length + more)
    items = [(i, prose(rng, length)) for i in range(20)]
    words = items[7][1].split()
    texts = []
    for at in range(2 * length):
        drawn = words[: length // 2] + prose(rng, more).split() + words[length // 2 :]
        texts.append(" ".join(prose(rng, at).split() + drawn + prose(rng, 200).split()))
    whole = decontam.shingles(decontam.words_of(" ".join(drawn)))
    own = decontam.shingles(words)
    assert len(own & whole) >= decontam.OVERLAP * len(own)
    found = decontam.Benchmark(items).hits(texts)
    assert [at for at, hits in enumerate(found) if 7 not in {h.item_id for h in hits.values()}] == []


def test_wand_scores_are_bm25():
    rng = random.Random(8)
    bench = decontam.Benchmark([(i, prose(rng, 20)) for i in range(80)])
    (index,) = bench.indexes
    for _ in range(60):
        terms = sorted(rng.sample(range(len(index.terms)), 40))
        scores = Counter()
        for t in terms:
            for item, weight in zip(index.postings[t].items, index.postings[t].weights, strict=True):
                scores[item] += weight
        want = {i: s for i, s in scores.items() if s >= 0.9999}
        assert dict(index.search(terms)) == pytest.approx(want)


def test_no_benchmark(spark, all_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find_contamination(all_docs, none).count() == 0
    assert decontam.clean_documents(all_docs, none).count() == all_docs.count()
    assert decontam.find_contamination(all_docs.limit(0), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0


# ---------------------------------------------------------------- sharding


def test_sharding_law(all_docs):
    rows = sharding.shard_documents(all_docs).collect()
    assert len(rows) == all_docs.count()
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, sharding.SHARDS) and 0 <= r.shard < sharding.SHARDS
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert len({(r.doc_id, r.shard) for r in rows}) == len({r.doc_id for r in rows})
    sizes = Counter((r.doc_id, r.size, r.text_crc32) for r in rows)
    assert sizes == Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in all_docs.collect())
    assert sharding.shard_documents(all_docs.limit(0)).count() == 0


def test_map_versions_only_give_to_the_new_shard():
    for n in (2, 7, 40):
        old, new = sharding.slot_map(n - 1, 512), sharding.slot_map(n, 512)
        assert all(b in (a, n - 1) for a, b in zip(old, new, strict=True))
        held = Counter(new)
        assert max(held.values()) - min(held.values()) <= 1 + 512 // n // 4


def test_rebalancing_evens_bytes():
    rng = random.Random(1)
    version, load = list(sharding.slot_map(8, 512)), [rng.randint(0, 1000) for _ in range(512)]
    after = sharding.rebalanced(version, load)
    totals = [sum(b for b, s in zip(load, after, strict=True) if s == shard) for shard in range(8)]
    assert max(totals) - min(totals) <= 0.02 * sum(load) / 8
    assert sharding.rebalanced([0, 1], [10**6, 1]) == [0, 1]


def test_stored_maps_are_edited_by_version(spark, tmp_path):
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, "x" * rng.randint(0, 2_000)) for i in range(3_000)], "doc_id long, text string")
    records = sharding.ordered_records(docs, 512)
    load, maps = sharding.slot_bytes(records), sharding.SlotMaps(spark, f"file://{tmp_path}")
    assert sum(load.values()) == docs.selectExpr("sum(length(text) + 16) as n").first().n
    maps.write(8, "key", list(sharding.slot_map(8, 512)), load)
    assert maps.grow(8) == 9 and maps.rebalance(8 + 1, load) == 10
    with pytest.raises(Exception, match="(?i)exist"):
        maps.grow(8)
    assert [r.shard for r in maps.read(9).orderBy("vslot").collect()] == list(sharding.slot_map(9, 512))
    totals = Counter()
    for r in maps.read(10).collect():
        totals[r.shard] += load.get(r.vslot, 0)
        assert r.law == "bytes"
    assert max(totals.values()) - min(totals.values()) <= 0.02 * sum(load.values()) / 9
    rows = sharding.place(records, maps, 10, slots=512).collect()
    assert len(rows) == 3_000 and {(r.law, r.grown_shard, r.map_version) for r in rows} == {("bytes", None, 10)}
    by_shard = defaultdict(int)
    for r in rows:
        by_shard[r.shard] += r.size
    assert by_shard == totals


def test_one_doc_id_may_hold_a_third_of_all_rows(spark):
    rows = [(None if i % 3 else i, f"text {i % 7 and i}", "key", 5) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, law string, slot int")
    found = sharding.shard_documents(docs).collect()
    assert Counter((r.doc_id, r.text_crc32) for r in found) == Counter((d, zlib.crc32(t.encode())) for d, t, *_ in rows)
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len({r.shard for r in found if r.doc_id is None}) == 1
    pieces = sharding.ordered_records(docs).where("doc_id is null").groupBy("piece").count().collect()
    assert len(pieces) > 1


# ---------------------------------------------------------------- nearest neighbours


def test_recall_and_exact_scores(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    ids, x = zip(*((r.vec_id, r.embedding) for r in table.collect()), strict=True)
    ids, x = np.array(ids), np.array(x, dtype=np.float64)
    got = defaultdict(list)
    for r in ann.nearest_neighbours(table, every=10).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    hits = 0
    assert set(got) == set(ids[ids % 10 == 0].tolist())
    for q, rows in got.items():
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(1))
        d[ids == q] = np.inf
        best = ids[np.lexsort((ids, d))[:10]]
        hits += len(set(best.tolist()) & {v for _, v, _ in rows})
        assert [r for r, _, _ in rows] == list(range(1, 11))
        assert all(s == pytest.approx(d[ids == v][0], rel=1e-12) for _, v, s in rows)
        assert [(s, v) for _, v, s in rows] == sorted((s, v) for _, v, s in rows)
    assert hits / (10 * len(got)) >= 0.9


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (3, [1.0, 0.0]), (2, [1.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (200, [0.0, 0.0]), (None, [1.0, 1.0])]
    found = ann.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in found] == [(0, 1, 2, 0.0), (0, 2, 3, 0.0), (0, 3, 100, 0.0), (100, 1, 0, 0.0), (100, 2, 2, 0.0), (100, 3, 3, 0.0)]
    assert ann.nearest_neighbours(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_ties_go_to_the_smaller_id(spark, monkeypatch):
    monkeypatch.setattr(ann, "RERANK", 12)
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300, 0, -1)] + [(i, rng.normal(size=3).tolist()) for i in range(301, 400)] + [(0, [1.0, 2.0, 3.0])]
    found = ann.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=1000).orderBy("rank").collect()
    assert [r.vec_id for r in found] == list(range(1, 11))


def test_results_do_not_depend_on_blocks_or_batches(spark, sf, monkeypatch):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    whole = sorted(tuple(r) for r in ann.nearest_neighbours(table).collect())
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    for limits in ({"QUERY_BLOCK": 2, "VECTOR_BLOCK": 64}, {"PART": 17, "QUERIES": 1}):
        with monkeypatch.context() as patch:
            for key, value in limits.items():
                patch.setattr(ann, key, value)
            spark.conf.set(name, 7)
            assert sorted(tuple(r) for r in ann.nearest_neighbours(table).collect()) == whole
    spark.conf.set(name, old)


def test_recall_where_a_small_share_is_reranked():
    """50,000 vectors in clusters and noise, 256 reranked: about half a percent."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(50_000, 64))
    x[:25_000] += 2 * rng.normal(size=(100, 64))[rng.integers(0, 100, 25_000)]
    x /= np.sqrt((x**2).sum(1, keepdims=True))
    books = ann.Books.fit(x[rng.choice(len(x), ann.SAMPLE, replace=False)])
    codes, norms = zip(*(books.encode(x[at : at + 1000]) for at in range(0, len(x), 1000)), strict=True)
    ids = np.arange(len(x))
    asked = ids[::500]
    block = ann.Block(books)
    block.ask(asked, x[asked])
    for at, c, n in zip(range(0, len(x), 1000), codes, norms, strict=True):
        block.offer(ids[at : at + 1000], ids[at : at + 1000], n.astype(np.float32), c)
    found = pa.Table.from_batches(block.found()).to_pandas().groupby("query_id")["row"].agg(set)
    d = (x**2).sum(1) - 2 * x[asked] @ x.T
    d[np.arange(len(asked)), asked] = np.inf
    assert all(len(s) == ann.RERANK for s in found)
    assert np.mean([len(found[q] & set(np.argsort(row)[:10].tolist())) / 10 for q, row in zip(asked, d, strict=True)]) >= 0.95


def test_lengths_repeats_and_clashing_columns(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 2), (1, [0.0, 1.0], 3), (1, [0.0, 1.0], 4), (2, [2.0, 0.0], 5), (3, [1.0, 0.0, 0.0], 6), (4, [], 7)]
    found = ann.nearest_neighbours(spark.createDataFrame(rows, "vec_id int, embedding array<double>, row int")).orderBy("rank").collect()
    assert [(r.query_id, r.vec_id, round(r.score, 6)) for r in found] == [(0, 2, 1.0), (0, 1, 1.414214), (0, 1, 1.414214)]
    assert found[0].asDict().keys() == {"query_id", "rank", "vec_id", "score"}
