"""The pipeline against a plain version of each stage, on documents with planted cases."""

import random
import re
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from driftfold.llm.queries import oracle_sql, queries
from tests.llm.test_search import brute_hits, edited, plain_components
from tests.llm.test_spans import luhn


def planted(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(80)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    base = [r.text for r in docs.collect() if len(r.text.split()) > 60]
    rng = random.Random(4)
    rows = [
        (5000, None, None, "s", None), (5001, "", "en", "s", 0), (5002, "12345 67890", "en", "s", 11),
        (5003, base[0], "en", "s", 1), (5004, edited(rng, base[1], 1), "en", "s", 1),
        (5005, base[2] + " " + items[0][1] + " tail of it", None, "s", 1),
        (5006, "the mail of anyone is a.b@example.com and the card 4111 1111 1111 1111 of the " + items[1][1][:40], "en", "s", 1),
        (5007, "a clean text of the and that with nothing in it for the others", None, "s", 1),
    ]
    return docs.unionByName(spark.createDataFrame(rows, docs.schema)), items


def test_stages_have_the_contracts_shape():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "pii", "bpe"]
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" in queries() and "pipeline" not in oracle_sql()
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries() if q.startswith("op")) == list(range(1, 11))


def test_pipeline_is_its_plain_stages(spark, sf, tmp_path):
    docs, items = planted(spark, sf)
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    rows = {r.doc_id: r for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    first = plain_components([(d, r.text) for d, r in rows.items()])
    rows = {d: r for d, r in rows.items() if first[d] == d}
    rows = {d: r for d, r in rows.items() if not brute_hits(items, r.text)}
    assert got.keys() == rows.keys()
    assert {5000, 5001, 5002, 5003, 5004, 5005}.isdisjoint(got) and {5006, 5007} <= got.keys()

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    emails = Counter()
    for d, r in got.items():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.decoded == library.decode(ids, skip_special_tokens=False) and r.n_chars == len(r.text)
        assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9-]+", r.text)
        assert not any(14 <= len(x) <= 19 and luhn(x) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", r.text) if (x := re.sub("[^0-9]", "", m[0])))
        emails[d] += r.text.count("<EMAIL>")
        if not any(tag in r.text for tag in ("<EMAIL>", "<IP>", "<CARD>", "<PHONE>", "<IBAN>")):
            assert r.text == rows[d].text
    assert emails[5006] == 1 and "<CARD>" in got[5006].text and got[5007].lang in {"en", "fr", "de", "es"}
