import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.llm.leakage import BlockShiftSearch, LeakRule, item_words, leaked_items, stock_sentences
from waymark.llm.packing import TOKENIZER, best_fit, load_tokenizer, pack_histogram, pack_texts, patterns, token_counts
from waymark.llm.reading import ReadingModel, fit_model, reading_levels, sentences, tokens
from waymark.llm.text import plain, words

VOCABULARY = [f"{a}{b}" for a in ("bar", "kel", "mon", "tis", "vor", "zan") for b in ("a", "ek", "il", "om", "ut")]


def passage(r, n):
    return [r.choice(VOCABULARY) for _ in range(n)]


def test_plain_text():
    assert words("The <b>Bür­ger</b>&nbsp;K<!-- x -->oln: ＡＢＣ, ____!") == ["the", "burger", "k", "oln", "abc", "____"]
    assert words(f"a <a href='{'q ' * 900}'>b</a> 3 < 4 <!-- c <i> --> d <!-- open") == ["a", "b", "3", "4", "d", "open"]
    assert words("BÃ¼rger") == ["burger"] and plain("") == "" and words("") == []


def brute_stretches(item, doc, rule):
    """Most words of runs on diagonals (single replaced words bridged) in order, by looking at every diagonal."""
    runs = []
    for off in range(-len(item), len(doc)):
        p = max(0, -off)
        hi = min(len(item), len(doc) - off)
        while p < hi:
            if item[p] != doc[p + off]:
                p += 1
                continue
            start, hits, end = p, 0, p
            while p < hi:
                if item[p] == doc[p + off]:
                    hits, end, p = hits + 1, p + 1, p + 1
                elif p + 1 < hi and item[p + 1] == doc[p + 1 + off]:
                    p += 1
                else:
                    break
            if hits >= rule.stretch:
                runs.append((start, end, hits, start + off, end + off))
            p = end
    best = []
    for s in sorted(runs):
        best.append(s[2] + max([best[i] for i, q in enumerate(sorted(runs)[: len(best)]) if q[1] <= s[0] and q[4] <= s[3]], default=0))
    return max(best, default=0) >= rule.total


def test_search_against_all_diagonals():
    r = random.Random(5)
    rule = LeakRule()
    items = {i: passage(r, r.randrange(20, 60)) for i in range(12)}
    search = BlockShiftSearch(items, rule=rule)
    for _ in range(150):
        doc = passage(r, r.randrange(0, 60))
        for _ in range(r.randrange(0, 3)):
            own = items[r.randrange(12)]
            a = r.randrange(len(own) - 8)
            cut = own[a : a + r.randrange(8, 40)]
            cut = [w if k % 9 != 6 or r.random() < 0.5 else "changed" for k, w in enumerate(cut)]
            at = r.randrange(len(doc) + 1)
            doc = doc[:at] + cut + doc[at:]
        want = sorted(i for i, item in items.items() if brute_stretches(item, doc, rule)) if len(doc) >= rule.total else []
        assert search.leaked(" ".join(doc)) == want


def test_leaked_items(spark):
    r = random.Random(6)
    texts = [passage(r, 40) for _ in range(6)]
    stock = "Answer with the name of one place only."
    items = spark.createDataFrame([(i, f"{' '.join(t).capitalize()}. {stock}") for i, t in enumerate(texts)] + [(9, None), (10, ""), (11, "too short here")], "item_id long, text string")
    decorated = "<p>" + " ".join(w.upper()[:2] + "­" + w.upper()[2:] for w in texts[0]) + "</p>"
    docs = [(1, decorated), (2, " ".join(texts[1][:15])), (3, " ".join(texts[2][5:18] + ["x", "y"] + texts[2][20:34])), (4, stock * 4), (5, ""), (6, None), (7, " ".join(passage(r, 30000) + texts[3])), (None, " ".join(texts[4])), (1, decorated)]
    d = spark.createDataFrame([(*x, "clash") for x in docs], "doc_id long, text string, item_id string").drop("item_id")
    got = {(x.doc_id, x.item_id) for x in leaked_items(d, items, "doc_id", "text", "item_id", "text").collect()}
    assert got == {(1, 0), (3, 2), (7, 3)}
    # Several search tables give the same, with the stock sentences of all items.
    assert {(x.doc_id, x.item_id) for x in leaked_items(d, items, "doc_id", "text", "item_id", "text", block_words=50).collect()} == got
    assert leaked_items(d.where("false"), items, "doc_id", "text", "item_id", "text").count() == 0
    assert leaked_items(d, items.where("false"), "doc_id", "text", "item_id", "text").count() == 0
    common = stock_sentences(items, "text")
    assert common == {tuple(words(stock))} and item_words(f"One two. {stock}", common) == ["one", "two"]


@pytest.mark.parametrize("capacity", [1, 7, 64])
def test_pack_histogram(capacity):
    r = random.Random(capacity)
    for scale in (1, 1000):
        h = np.array([r.randrange(0, 9) * scale for _ in range(capacity + 1)])
        plan = pack_histogram(h)
        used = np.zeros(capacity + 1, dtype=int)
        for lengths, n in plan:
            assert sum(lengths) <= capacity and n > 0
            for x in lengths:
                used[x] += n
        assert (used[1:] == h[1:]).all()
        need, bins = int((h * np.arange(capacity + 1)).sum()), sum(n for _, n in plan)
        assert bins <= max(1, 1.12 * need / capacity) + 1
    assert pack_histogram(np.zeros(capacity + 1, dtype=int)) == []
    table = patterns(7, np.arange(1, 8))
    assert {tuple(x) for x in table.tolist()} == {(7, 0, 0), (6, 1, 0), (5, 2, 0), (4, 3, 0), (5, 1, 1), (4, 2, 1), (3, 3, 1), (3, 2, 2)} and len(table) == 8
    assert (patterns(5000, np.arange(1, 5001)).sum(axis=1) == 5000).all() and len(patterns(5000, np.arange(1, 5001), 10_000)) < 20_000
    assert sum(n for _, n in best_fit(np.array([0, 3, 0, 1]))) == 2


def test_pack_texts(spark):
    r = random.Random(8)
    data = [(f"d{i}" if i % 40 else None, r.choice([0, None, 5, 5, 5, 17, 40, 64, 65, 200, -3])) for i in range(400)]
    df = spark.createDataFrame(data, "k string, n_tokens long").repartition(6)
    rows = pack_texts(df, "k", 64).collect()
    assert sorted((x.k or "", x.n_tokens) for x in rows if x.sequence is None) == sorted((k or "", 0) for k, n in data if not n or n < 0)
    full = {}
    for x in rows:
        if x.sequence is not None:
            full.setdefault(x.sequence, []).append((x.position, x.n_tokens))
    for own in full.values():
        at = 0
        for p, n in sorted(own):
            assert p == at
            at += n
        assert at <= 64
    assert sorted(full) == list(range(len(full)))
    total = {}
    for x in rows:
        if x.sequence is not None:
            assert x.start == x.piece * 64
            total[x.k] = total.get(x.k, 0) + x.n_tokens
    want = {}
    for k, n in data:
        if n and n > 0:
            want[k] = want.get(k, 0) + n
    assert total == want
    # A text that fits is never cut.
    assert all(x.piece == 0 for x in rows if x.k and dict(data)[x.k] and dict(data)[x.k] <= 64)
    fits = {(x.sequence, x.position, x.k, x.n_tokens) for x in pack_texts(df.repartition(3), "k", 64).collect() if x.k}
    assert fits == {(x.sequence, x.position, x.k, x.n_tokens) for x in rows if x.k}
    assert pack_texts(df.where("false"), "k", 64).count() == 0


def test_many_buckets_give_the_same_fill(spark, monkeypatch):
    from waymark.llm import packing

    df = spark.createDataFrame([(i, 1 + i % 9) for i in range(500)], "k long, n_tokens long")
    one = packing.pack_texts(df, "k", 16)
    monkeypatch.setattr(packing, "ITEMS_PER_BUCKET", 30)
    many = packing.pack_texts(df, "k", 16)
    shape = lambda d: sorted((x.sequence, x.position, x.n_tokens) for x in d.collect())
    assert shape(one) == shape(many) and many.select("k").distinct().count() == 500


@pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no tokenizer files")
def test_token_counts(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, ""), (3, None), (4, "word " * 30000), (5, "<|endoftext|>")], "k long, text string")
    got = {x.k: x.n_tokens for x in token_counts(df, "k", "text").collect()}
    assert got[1] == 3 and got[2] == got[3] == 0 and got[4] == 30001 and got[5] > 1
    assert load_tokenizer(TOKENIZER)("Hello world") == 2


def level_text(r, grade, n=12):
    pools = [["cat", "dog", "sun", "hat", "run"], ["garden", "window", "basket", "summer"], ["distance", "interest", "memory", "journey"], ["perspective", "negotiate", "structure"], ["epistemology", "jurisprudence", "phenomenology"]]
    return " ".join(" ".join(r.choice(pools[grade - 1] if r.random() < 0.8 else pools[r.randrange(5)]) for _ in range(4 + 3 * grade)) .capitalize() + "." for _ in range(n))


def test_reading_levels(spark):
    r = random.Random(4)
    train = [(i, level_text(r, 1 + i % 5), 1 + i % 5) for i in range(100)]
    test = [(1000 + i, level_text(r, 1 + i % 5), 1 + i % 5) for i in range(60)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in train + test] + [(1, None), (5000, ""), (5001, None), (5002, "..."), (5003, level_text(r, 5, 2000))], "doc_id long, text string")
    labels = spark.createDataFrame([(k, g) for k, _, g in train] + [(3, 9), (None, 2), (4, None), (7, 3)], "doc_id long, grade int")
    model = fit_model(docs, labels, "doc_id", "text", "grade")
    got = {x.doc_id: x.grade for x in reading_levels(docs, model, "doc_id", "text").where("doc_id >= 1000").collect()}
    hits = sum(got[k] == g for k, _, g in test)
    assert hits >= 54 and got[5000] is None and got[5001] is None and got[5003] == 5
    assert reading_levels(docs.where("false"), model, "doc_id", "text").count() == 0
    nothing = fit_model(docs, labels.where("false"), "doc_id", "text", "grade")
    assert reading_levels(docs.limit(3), nothing, "doc_id", "text").where("grade is not null").count() == 0


def test_sentences_and_tokens():
    assert [s.strip() for s in sentences("<p>One two.</p><p>Three; four! Five</p>")] == ["One two.", "Three;", "four!", "Five"]
    assert tokens("The old Kolmar has 12 gates") == ["the", "old", "^n", "has", "^0", "gates", "^l2"]
    assert isinstance(ReadingModel([], np.zeros((0, 5))).document, type(None))
