import math
import random
import re

import numpy as np
import pytest

from tests.llm.samples import ODD, docs
from vidstrata.llm import ranked_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(rows, items, k):
    """[(item_id, rank, doc_id, score)] by the stated formula."""
    cut = [(i, terms(t)) for i, t in rows]
    sizes = [(i, w) for i, w in cut if w]
    n_docs, total = len(sizes), sum(len(w) for _, w in sizes)
    df = {}
    for _, w in sizes:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for doc, w in sizes:
            m = 50 + (50 * len(w) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * w.count(t)) // (1000 * w.count(t) + 20 * m))
                for t in set(terms(text))
                if t in w
            )
            if score > 0:
                scored.append((-score, doc is None, doc))
        scored.sort()
        out += [(item, r + 1, s[2], -s[0]) for r, s in enumerate(scored[:k])]
    return out


def corpus(seed=0, size=300):
    """Words of falling frequency, with repeated texts, so that scores tie."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    weights = [1 / (i + 1) for i in range(200)]
    texts = [" ".join(rng.choices(words, weights, k=rng.randrange(1, 60))) for _ in range(size)]
    return texts + texts[:40] + [texts[0]] * 30 + ODD + ["W1, w2;W3-w1 ÉÜ éü\x00w5\x7fw6"]


@pytest.mark.parametrize("short", [2, 16, 1 << 20])
def test_ranks_equal_brute_force(spark, monkeypatch, short):
    monkeypatch.setattr(ranked_search, "SHORT", short)
    monkeypatch.setattr(ranked_search, "RANGE", 16)
    monkeypatch.setattr(ranked_search, "SHARD_ROWS", 64)
    monkeypatch.setattr(ranked_search, "SEED_ROWS", 40)
    monkeypatch.setattr(ranked_search, "ITEM_TERMS", 60)
    texts = corpus()
    rng = random.Random(4)
    items = [(i, " ".join(rng.choices([f"W{j}" for j in range(200)], k=rng.randrange(0, 30)))) for i in range(20)]
    items += [(50, "w0 w1 w0 W1"), (51, None), (52, "!!! w1"), (53, "unheard of"), (54, "Éü ÉÜ éü w5 w6")]
    asked = spark.createDataFrame([(i, t, 0, "own") for i, t in items], "item_id long, text string, rank int, item string").repartition(2)
    found = ranked_search.top_k(docs(spark, texts), asked, k=7).collect()
    want = brute(list(enumerate(texts)), items, 7)
    assert sorted(tuple(r) for r in found) == sorted(want)


def test_skips_what_can_not_rank():
    """Long lists are looked up only for documents that can still reach the k-th score."""
    import pyarrow as pa

    rows = 4000
    own = [[0, 1] if i % 400 == 0 else [1] for i in range(rows)]
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": list(range(rows)), "n": [10] * rows, "term": pa.array(own, pa.list_(pa.int32())), "tf": pa.array([[1] * len(o) for o in own], pa.list_(pa.int32()))}
    )
    shard = ranked_search.Shard([batch], np.array([9000, 10]), rows, 10 * rows)
    lists = shard.lists(np.array([0, 1]))
    assert [len(d) for d, _, _ in lists] == [rows, 10]  # the short list became the accumulators
    doc, score, least = shard.search(np.array([0, 1]), 1, 5)
    assert doc.tolist() == [0, 400, 800, 1200, 1600]
    assert least == score[-1]
    assert len(shard.search(np.array([1]), least, 5)[0]) == 0


def test_repeated_and_null_ids(spark):
    schema = "doc_id long, text string"
    rows = [(1, "a b"), (1, "a b"), (None, "a b"), (2, "c"), (3, None), (4, "d e"), (5, "f")]
    given = spark.createDataFrame(rows, schema)
    items = spark.createDataFrame([(7, "a"), (7, "c"), (None, "a")], "item_id long, text string")
    found = [tuple(r) for r in ranked_search.top_k(given, items, k=5).collect()]
    assert [r[2] for r in found if r[0] is None] == [1, 1, None]
    assert sorted(r[1] for r in found if r[0] == 7) == [1, 1, 2, 3]
    assert ranked_search.top_k(given.where("false"), items).collect() == []
    assert ranked_search.top_k(given, items.where("false")).collect() == []
    assert ranked_search.top_k(spark.createDataFrame([(1, None)], schema), items).collect() == []


def test_a_very_long_text(spark):
    given = spark.createDataFrame([(1, "rare " + "common " * 800_000), (2, "rare"), (3, "other words")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "rare common")], "item_id long, text string")
    want = brute([tuple(r) for r in given.collect()], [(1, "rare common")], 50)
    assert sorted(tuple(r) for r in ranked_search.top_k(given, items).collect()) == sorted(want)
