"""Operators 2 and 4 against the tokenizers library on whole texts."""

import hashlib
import json
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from driftfold.llm import bpe, tokenfile, wordtable

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:])))


def test_ids_and_text_are_the_librarys(all_docs, library):
    want = []
    for r in all_docs.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert order(tuple(r) for r in bpe.bpe_digest(all_docs, PATH).collect()) == order(want)


@pytest.mark.parametrize("head", [0, 50])
def test_a_small_head_changes_nothing(all_docs, monkeypatch, head):
    whole = order(tuple(r) for r in bpe.bpe_digest(all_docs, PATH).collect())
    monkeypatch.setattr(wordtable.head_of, "__defaults__", (head,))
    monkeypatch.setattr(bpe, "MEMO", 10)
    monkeypatch.setattr(bpe, "TAIL_MEMO", 10)
    assert order(tuple(r) for r in bpe.bpe_digest(all_docs, PATH).collect()) == whole


def test_a_head_takes_little_memory_and_has_every_word():
    words = [f"w{i}" for i in range(30_000)] + ["été", "w" * 4_000]
    plain = bpe.coder(spec := bpe.read_spec(PATH))
    table = pa.table({"word": words, "ids": pa.array([plain.ids_of(w) for w in words], pa.binary())})
    tracemalloc.start()
    try:
        head = bpe.Head(bpe.packed(table))
        taken = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    # A dict of strings and bytes takes about 160 bytes a word.
    assert taken < 60 * len(words)
    assert [head.ids_of(w) for w in words] == table.column("ids").to_pylist()
    assert head.ids_of("w30000") is None and bpe.Head(bpe.packed(table.slice(0, 0))).ids_of("w1") is None
    coder = bpe.WordCoder(spec, head)
    assert [coder[w] for w in [*words[::100], "été", "w30000"]] == [plain.ids_of(w) for w in [*words[::100], "été", "w30000"]]


def test_batches_of_long_texts_are_small(spark):
    docs = bpe.small_batches(spark.range(400).selectExpr("id", "repeat('word ', 4000) text").coalesce(1))
    sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()
    assert len(sizes) > 1 and max(r.n for r in sizes) < 2 << 20


def test_encode_documents_keeps_columns(odd_docs, library):
    rows = bpe.encode_documents(odd_docs, PATH).collect()
    assert rows[0].asDict().keys() == {*odd_docs.columns, "decoded"}
    for r in rows:
        assert r.ids == packed(library.encode(r.text or "", add_special_tokens=False).ids)


def test_other_tokenizers_are_refused(spark, tmp_path):
    other = json.loads(open(PATH).read())
    other["normalizer"] = None
    (tmp_path / "other.json").write_text(json.dumps(other))
    with pytest.raises(ValueError, match="another way"):
        bpe.WordCoder(bpe.read_spec(str(tmp_path / "other.json")))


def test_word_counts(spark, all_docs):
    def splitter():
        return str.split

    got = {r.word: (r.n, r.n_weighted) for r in wordtable.count_words(all_docs.selectExpr("text", "doc_id < 100 as low").na.fill(False), splitter, "low").collect()}
    want = {}
    for r in all_docs.collect():
        for w in (r.text or "").split():
            n, m = want.get(w, (0, 0))
            want[w] = (n + 1, m + (r.doc_id is not None and r.doc_id < 100))
    assert got == want
    head = wordtable.head_of(spark.createDataFrame([("a", 100), ("b", 90), ("c", 1), ("d" * 40, 500), ("e" * 5_000, 900)], "word string, n long"), 2)
    assert {r.word for r in head.collect()} == {"a", "b", "d" * 40}


def test_segments_read_back(all_docs, library):
    rows = order(tuple(r) for r in tokenfile.token_index(all_docs, PATH).collect())
    want, start = [], 0
    texts = sorted(((r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids + [tokenfile.END_ID]) for r in all_docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0, len(x[1])))
    for doc_id, ids in texts:
        want.append((doc_id, start, len(ids), zlib.crc32(packed(ids))))
        start += len(ids)
    assert rows == order(want)


def test_one_document_from_a_segment():
    codec = tokenfile.Codec(2, tokenfile.train_dictionary([np.arange(i, i + 200, dtype="<u2").tobytes() for i in range(400)]))
    docs = [(7, [1, 2, 3]), (None, [9] * 500), (-4, [49407])]
    frames = [tokenfile._compressor(codec).compress(np.array(ids, "<u2").tobytes()) for _, ids in docs]
    seg = tokenfile.Segment(tokenfile.pack([(d, len(ids), f) for (d, ids), f in zip(docs, frames, strict=True)], 100, codec), codec)
    assert [seg.doc_id(i) for i in range(3)] == [7, None, -4] and seg.starts.tolist() == [100, 103, 603]
    assert seg.ids(1).tolist() == [9] * 500
    with pytest.raises(ValueError, match="another dictionary"):
        tokenfile.Segment(tokenfile.pack([(1, 1, b"")], 0, codec), tokenfile.Codec(2, b"other"))


def test_empty_table(all_docs):
    none = all_docs.limit(0)
    assert bpe.bpe_digest(none, PATH).count() == 0 and tokenfile.token_index(none, PATH).count() == 0
