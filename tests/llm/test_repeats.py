import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.samples import ODD, docs
from vidstrata.llm import repeats
from vidstrata.llm.common import stored


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    times = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = {}
    for doc, t in enumerate(raw):
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if times[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed, length, count=70):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab c") for _ in range(rng.randrange(0, length * 3))) for _ in range(20)]
    texts = []
    for _ in range(count):
        kind = rng.random()
        if kind < 0.3:
            texts.append(rng.choice(base))
        elif kind < 0.6:
            texts.append("".join(rng.choice(base)[rng.randrange(0, length) :][: rng.randrange(1, 2 * length)] for _ in range(4)))
        elif kind < 0.7:
            texts.append(rng.choice(["ab", "x", "hé ", "\0\0a"]) * rng.randrange(1, length * 3))
        else:
            texts.append("".join(rng.choice("abcdefgé\0") for _ in range(rng.randrange(0, length * 4))))
    return texts + ODD + texts[:2]


@pytest.mark.parametrize("length, hot", [(20, repeats.HOT), (20, 3), (200, repeats.HOT), (30, 1)])
def test_cut_equals_brute_force(spark, length, hot):
    texts = corpus(length + hot, length)
    found = repeats.cut(docs(spark, texts), length, hot=hot).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found}
    assert len(found) == len(texts)
    assert got == brute(texts, length)


def test_texts_without_their_repeats(spark):
    passage = "".join(random.Random(1).choice("abcdefgh ") for _ in range(260))
    texts = [f"one {passage} end", f"two {passage}", "clean", None, "copy " * 60, "copy " * 60]
    given = docs(spark, texts)
    found = repeats.without_repeats(given)
    assert found.columns == given.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in found.collect()}
    # the blank before the passage repeats too
    assert got == {0: ("one end", 7), 1: ("two", 3), 2: ("clean", 5), 3: (None, 0), 4: ("", 0), 5: ("", 0)}


def test_rows_of_hot_keys_stay_where_they_are(spark):
    given = spark.range(0, 60_000, 1, 8).selectExpr("if(id % 3 = 0, -1, id div 4) as h", "id")
    counts = stored(given.groupBy("h").agg(F.count("*").alias("times")).where("times > 1"), "test-counts")
    wanted = given.join(counts, "h")
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = repeats.repeated(given, ["h"], counts)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) < 0.3 * sum(sizes)
        assert "Window" not in found._jdf.queryExecution().toString()
        every = repeats.repeated(given, ["h"], counts, once=True)
        assert every.count() == 60_000
        assert every.where("times IS NULL").count() == given.join(counts, "h", "left_anti").count()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert found.exceptAll(wanted.select(found.columns)).isEmpty() and found.count() == wanted.count()


def test_broadcast_keys_are_bounded_by_their_bytes(spark, monkeypatch):
    keys = spark.createDataFrame([("x" * 1000, 1), (None, None)], "id string, digest long")
    monkeypatch.setattr(repeats, "FEW_BYTES", 1033)
    assert repeats.few(keys)
    monkeypatch.setattr(repeats, "FEW_BYTES", 1032)
    assert not repeats.few(keys)
    assert repeats.few(keys.where("false"))


@pytest.mark.parametrize("hot", [repeats.HOT, 3])
def test_cut_without_broadcasts(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "FEW_BYTES", -1)
    texts = corpus(5, 20)
    found = repeats.cut(docs(spark, texts), 20, hot=hot).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == brute(texts, 20)


def test_empty_table(spark):
    assert repeats.cut(docs(spark, ["x"]).where("false")).collect() == []
    assert repeats.without_repeats(docs(spark, ["x"]).where("false")).collect() == []


def test_anchors_of_long_text_do_not_depend_on_blocks(monkeypatch):
    text = bytes(random.Random(2).choices(range(97, 103), k=5000))
    whole = repeats.anchors(text, 60)
    monkeypatch.setattr(repeats, "BLOCK", 700)
    assert all((a == b).all() for a, b in zip(whole, repeats.anchors(text, 60), strict=True))


def test_multikey_order_sorts():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 3, (200, 4)).astype(np.uint64)
    group, sizes = rng.integers(0, 4, 200), rng.integers(0, 2, 200)
    order, shared = repeats.multikey_order(group, words, sizes)
    keys = [(group[i], *words[i]) for i in order]
    assert keys == sorted(keys)
    for i in range(1, 200):
        same = 0
        while same < 4 and words[order[i], same] == words[order[i - 1], same]:
            same += 1
        assert shared[i] == (same if group[order[i]] == group[order[i - 1]] else -1)
