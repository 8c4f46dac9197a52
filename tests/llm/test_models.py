"""Operators 1 and 3: held-out accuracy, and plain versions of the parse and of the byte model."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driftfold.llm import langid, lm


def phrases(text, labelled):
    """Greedy longest phrases that occur in the labelled text; a character that does not is a phrase of its own."""
    n, at = 0, 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in labelled:
            end += 1
        at = max(at + 1, end - 1)
        n += 1
    return n


@settings(max_examples=60, deadline=None)
@given(st.text("abc", min_size=1, max_size=40), st.text("abcd", min_size=1, max_size=60))
def test_automaton_parses_as_substring_search(labelled, text):
    parser = langid.Parser(langid.Languages((("x", labelled),)))
    codes = parser.codes(parser.normal(text)[0])
    normal = "".join(map(chr, parser.normal(text)[0]))
    assert parser.phrases([codes])[0, 0] == phrases(normal, labelled)


SCRIPTS = {
    "zh": ("今天天气很好，我们去公园散步。孩子们在草地上玩耍，老人们坐在长椅上聊天。", "晚上我们一起回家做饭，孩子们坐在桌子旁边等着吃饭。"),
    "ja": ("今日は天気がとても良いので、公園を散歩しました。子供たちは芝生の上で遊んでいました。", "夜は一緒に家に帰って、子供たちはテーブルのそばで待っていました。"),
    "ko": ("오늘은 날씨가 아주 좋아서 공원을 산책했습니다. 아이들은 잔디밭에서 놀고 있었습니다.", "저녁에는 함께 집에 돌아와서 아이들은 식탁 옆에서 기다리고 있었습니다."),
    "ru": ("Сегодня очень хорошая погода, и мы гуляли в парке. Дети играли на траве.", "Вечером мы вместе вернулись домой, и дети ждали за столом."),
    "uk": ("Сьогодні дуже гарна погода, і ми гуляли в парку. Діти гралися на траві.", "Увечері ми разом повернулися додому, і діти чекали за столом."),
    "en": ("The weather is very good today and we went for a walk in the park.", "In the evening we went home together, and the children waited at the table."),
}


def plain_prediction(languages, text):
    """The contract of the parser in plain Python: normalise, cut into longest phrases, weigh, take the least."""
    def normal(t):
        return re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in t.lower())).lstrip(" ").encode()

    texts = {k: normal(v) for k, v in languages}
    width = len({b for t in texts.values() for b in t} | {32}) + 1
    own = normal(text)
    if not any(c.isalpha() for c in text.lower()):
        return "und"
    each = {k: math.log2(len(t) + width) for k, t in texts.items()}
    cost = {}
    for k, t in texts.items():
        n = sum(phrases(own[at : at + langid.SEGMENT], t) for at in range(0, len(own), langid.SEGMENT))
        cost[k] = n * each[k] + sum(b not in t for b in own) * (max(each.values()) - each[k])
    return min(sorted(cost), key=cost.get)


def test_scripts_are_told_apart():
    languages = langid.Languages(tuple((k, a * 3) for k, (a, _) in sorted(SCRIPTS.items())))
    names, scores, _ = langid.Parser(languages).predict([b for _, b in SCRIPTS.values()])
    assert names == list(SCRIPTS) and all(0 < s <= 1 for s in scores)


def test_predictions_are_the_plain_parsers(all_docs):
    learned = langid.train(all_docs)
    languages = [(k, v[:1500]) for k, v in learned.texts] + [(k, a) for k, (a, _) in SCRIPTS.items() if k not in dict(learned.texts)]
    texts = [r.text or "" for r in all_docs.orderBy("doc_id").limit(40).collect()] + [b for _, b in SCRIPTS.values()] + ["", "12", "𝔘𝔫𝔦 😀 ñandú"]
    texts = [t[:4000] for t in texts]
    got = langid.Parser(langid.Languages(tuple(languages))).predict(texts)[0]
    assert got == [plain_prediction(languages, t) for t in texts]


def test_labels_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    rows = [(i, f"some words of label {chr(97 + i % 3)}", "abc"[i % 3]) for i in range(8)]
    assert langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string")).names == ["a", "b"]


def test_held_out_accuracy(all_docs):
    rows = langid.held_out_prediction(all_docs).collect()
    truth = {r.doc_id: r.lang for r in all_docs.collect()}
    held = [r for r in rows if r.held_out and r.doc_id is not None and truth[r.doc_id]]
    assert {r.doc_id for r in held} == {d for d, x in truth.items() if d is not None and x and zlib.crc32(str(d).encode()) % 5 == 0}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(odd_docs, all_docs):
    learned = langid.train(all_docs)
    got = langid.identify(odd_docs, learned)
    assert {"lang_pred", "score", "ids"} <= set(got.columns) and got.columns.count("score") == 1
    und = sorted({r.doc_id for r in got.collect() if r.lang_pred == "und"})
    assert und == [900, 901, 902, 903]
    assert all(r.score == 0 for r in got.collect() if r.lang_pred == "und")
    assert {r.lang_pred for r in langid.identify(odd_docs, langid.Languages(())).collect()} == {"und"}
    assert langid.held_out_prediction(odd_docs.limit(0)).count() == 0


def test_little_labelled_text_does_not_win(spark, all_docs):
    little = [(5000, "", "aa"), (5001, "12 34", "ab"), (5002, "hola", "ac"), (5003, "\u4f60", "ad")]
    docs = all_docs.where("lang is not null").select("doc_id", "text", "lang")
    learned = langid.train(docs.unionByName(spark.createDataFrame(little, docs.schema)))
    assert not {"aa", "ab"} & set(learned.names) and {"ac", "ad", "en"} <= set(learned.names)
    texts = [(r.text, r.lang) for r in docs.collect() if r.doc_id is not None and r.doc_id < 900 and len((r.text or "").split()) >= 10]
    names, _, bits = langid.Parser(learned).predict([t for t, _ in texts])
    assert sum(n == x for n, (_, x) in zip(names, texts, strict=True)) > 0.97 * len(texts) and len(texts) > 100
    # Nor the texts of a script that no language has.
    two = langid.Parser(langid.Languages((("en", "the quick brown fox"), ("zz", "q"))))
    assert two.predict(["\u4f60\u597d \u4e16\u754c"])[0] == ["en"]


def plain_ppm(train, text):
    """log10 P(text) by walking down from the longest context, symbol by symbol."""
    counts = defaultdict(Counter)
    for s in train:
        padded = bytes(lm.ORDER) + s
        for i in range(lm.ORDER, len(padded)):
            for k in range(lm.ORDER + 1):
                counts[padded[i - k : i]][padded[i]] += 1
    total, padded = 0.0, bytes(lm.ORDER) + text
    for i in range(lm.ORDER, len(padded)):
        barred = set()
        for k in range(lm.ORDER, -1, -1):
            here = {c: n for c, n in counts[padded[i - k : i]].items() if c not in barred}
            if not here:
                continue
            base = sum(here.values()) + len(here)
            if padded[i] in here:
                total += math.log10(here[padded[i]] / base)
                break
            total += math.log10(len(here) / base)
            barred |= here.keys()
        else:
            total -= math.log10(256 - len(barred))
    return total


@settings(max_examples=30, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=12), min_size=0, max_size=8), st.binary(max_size=30), st.lists(st.sampled_from([b"abab", b"abc", b"cab"]), max_size=6))
def test_scorer_is_ppm(noise, text, words):
    train = [x + lm.END for x in [*noise, *words]]
    codes, n = np.unique(lm.gram_codes(train), return_counts=True) if train else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    for probe in (text + lm.END, b"ababc" + lm.END):
        assert lm.Scorer(lm.Trie(codes, n)).log10(lm.gram_codes([probe])).sum() == pytest.approx(plain_ppm(train, probe), abs=1e-4)


def test_score_documents(all_docs):
    docs = all_docs.limit(150).unionByName(all_docs.where("doc_id >= 900 or doc_id is null"))
    rows = docs.select("doc_id", "text").collect()
    held = {r.doc_id: r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows}
    tokens = [(r.doc_id, lm.tokens_of(r.text or "") + [None]) for r in rows]
    counts = Counter(t for d, ts in tokens if not held[d] for t in ts)
    n, v = sum(counts.values()), len(counts)
    train = [lm.stream(ts[:-1]) for d, ts in tokens if not held[d]]
    got = lm.score_documents(docs).collect()
    assert len(got) == len(rows)
    plain = defaultdict(list)
    for d, ts in tokens:
        plain[d].append((len(ts), sum(counts[t] > 0 for t in ts), sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts), ts))
    for r in got:
        want = min(plain[r.doc_id], key=lambda x: (x[0] != r.n_tokens, abs(x[2] - r.base_score)))
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], want[0], want[1], n)
        assert r.base_score == pytest.approx(want[2], rel=1e-9)
    for d in (3, 901, 904):
        own = next(r for r in got if r.doc_id == d)
        assert own.score == pytest.approx(plain_ppm(train, lm.stream(plain[d][0][3][:-1])), rel=1e-4)


def test_tail_words_meet_their_counts(all_docs, monkeypatch):
    docs = all_docs.limit(60)
    whole = sorted((r.doc_id, r.n_known, round(r.base_score, 6)) for r in lm.score_documents(docs).collect())
    monkeypatch.setattr(lm, "head_of", lambda words: words.limit(0))
    assert sorted((r.doc_id, r.n_known, round(r.base_score, 6)) for r in lm.score_documents(docs).collect()) == whole


def test_a_pruned_trie_still_scores(all_docs):
    small = lm.train_trie(all_docs.limit(40), nodes=500)
    assert 0 < len(small.grams) <= 500
    assert np.isfinite(lm.Scorer(small).log10(lm.gram_codes([b"anything at all\n"]))).all()


@pytest.mark.parametrize("nodes", [0, 300, lm.NODES])
def test_grams_outside_the_head_meet_their_counts(all_docs, nodes):
    docs = all_docs.where("doc_id < 40 or doc_id = 901").selectExpr("doc_id", "substr(text, 1, 400) || if(doc_id % 3 = 0, ' \u4f60\u597d\u20ac', '') as text")
    texts = {r.doc_id: lm.stream(lm.tokens_of(r.text or "")) for r in docs.collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    train = [s for d, s in texts.items() if not held[d]]
    got = {r.doc_id: r.score for r in lm.score_documents(docs, nodes).collect()}
    assert any(held.values()) and got == pytest.approx({d: plain_ppm(train, s) for d, s in texts.items()}, rel=1e-5)


def test_no_training_texts(spark):
    only = spark.createDataFrame([(d, "held out") for d in range(200) if zlib.crc32(str(d).encode()) % 7 == 2][:2], "doc_id long, text string")
    rows = lm.score_documents(only).collect()
    assert {(r.n_known, r.train_tokens, r.n_tokens, r.base_score) for r in rows} == {(0, 0, 3, 0.0)}
    assert rows[0].score == pytest.approx(-9 * math.log10(256))
    assert lm.score_documents(only.limit(0)).count() == 0
