"""Mixing and packing."""

import math
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.samples import ODD, docs, near_copies
from vidstrata.llm import mixing, packing

SF = "/root/testdata/sf0.001/documents.parquet"


def expected_targets(sizes, weights=(1, 2, 3), most=3):
    """{source: size} -> {source: target}, by sharing again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        shared = sum(weight[s] for s in names if s not in full)
        goal = {s: most * sizes[s] if s in full else left * weight[s] / shared for s in names}
        over = {s for s in names if s not in full and goal[s] > most * sizes[s]}
        if not over:
            return goal
        full |= over


def test_targets_and_takings(spark):
    rows = mixing.mix(spark.read.parquet(SF)).collect()
    sizes, taken, largest, goal = defaultdict(int), defaultdict(int), defaultdict(int), {}
    for r in rows:
        assert r.size == len([w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", r.text or "")])
        assert r.taken == r.copies * r.size <= 3 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        goal[r.source] = r.target
    want = expected_targets(dict(sizes))
    for s, size in sizes.items():
        assert all(r.source_size == size for r in rows if r.source == s)
        assert math.isclose(goal[s], want[s], rel_tol=1e-9, abs_tol=1e-9)
        assert abs(taken[s] - want[s]) <= largest[s]


def test_rates_solve_the_token_constraints(spark):
    rows = mixing.mix(spark.read.parquet(SF)).collect()
    held = defaultdict(float)
    for r in rows:
        held[r.source] += r.rate * r.size
    assert all(math.isclose(held[r.source], r.target, rel_tol=1e-6) for r in rows)
    # within a source the log of a rate is in proportion to the size, up to the limit
    for source in {r.source for r in rows}:
        slopes = [math.log(r.rate) / r.size for r in rows if r.source == source and r.size and r.rate < 2.999]
        assert max(slopes, default=0) - min(slopes, default=0) < 1e-9


@pytest.mark.parametrize("same_text", [False, True])
def test_rows_of_one_id_share_the_extra_copies(spark, monkeypatch, same_text):
    monkeypatch.setattr(mixing, "PIECE", 100)
    text = F.lit("a b c") if same_text else F.concat(F.lit("a b c"), F.col("i"))
    ids = F.expr("CASE WHEN i < 3000 THEN NULL WHEN i < 3010 THEN 7 ELSE i END")
    given = spark.range(6000).withColumnRenamed("id", "i").select(
        ids.alias("doc_id"), text.alias("text"), F.expr("CASE WHEN i % 2 = 0 OR i >= 5000 THEN 's0' ELSE 's1' END").alias("source")
    )
    runs = []
    for parts in (2, 5):
        rows = mixing.mix(given.repartition(parts)).collect()
        assert len(rows) == 6000
        taken, goal = defaultdict(int), {r.source: r.target for r in rows}
        for r in rows:
            taken[r.source] += r.taken
            assert r.copies in (math.floor(r.rate), math.floor(r.rate) + 1)
        assert all(abs(taken[s] - goal[s]) <= 3 for s in goal)
        for s in goal:
            null = [r for r in rows if r.doc_id is None and r.source == s]
            assert abs(np.mean([r.copies for r in null]) - null[0].rate) < 0.1
        runs.append(sorted((r.source, r.doc_id or -1, r.text, r.taken) for r in rows))
    assert runs[0] == runs[1]


def test_full_sources_and_odd_rows(spark):
    texts = ["w " * 400, "w " * 10, "w " * 10, *ODD]
    given = docs(spark, texts).withColumn("source", F.expr("CASE WHEN doc_id = 0 THEN 'big' WHEN doc_id < 3 THEN 'tiny' WHEN doc_id < 6 THEN 'none' END"))
    rows = mixing.mix(given).collect()
    assert len(rows) == len(texts)
    goal = {r.source: r.target for r in rows}
    sizes = {r.source: r.source_size for r in rows}
    assert sizes["tiny"] == 20 and goal["tiny"] == 60
    assert all(r.taken == 30 for r in rows if r.source == "tiny")
    want = expected_targets(sizes)
    assert all(math.isclose(goal[s], want[s], rel_tol=1e-9, abs_tol=1e-9) for s in want)


def test_reruns_and_partitions_agree(spark):
    given = spark.read.parquet(SF)
    a, b = ({(r.doc_id, r.taken) for r in mixing.mix(given.repartition(n)).collect()} for n in (2, 7))
    assert a == b


def test_mixed_repeats_rows(spark):
    given = docs(spark, near_copies(bases=5))
    want = sorted(r.doc_id for r in mixing.mix(given).collect() for _ in range(r.copies))
    found = mixing.mixed(given)
    assert found.columns == given.columns
    got = found.collect()
    assert sorted(r.doc_id for r in got) == want
    assert all(r["size"] == -1 for r in got)


def test_no_python_in_the_mixing_plan(spark, capsys):
    mixing.mix(spark.read.parquet(SF)).explain()
    assert "Python" not in capsys.readouterr().out


def test_empty_tables(spark):
    none = docs(spark, ["x"]).where("false")
    assert mixing.mix(none).collect() == []
    assert mixing.mixed(none).collect() == []
    assert packing.pack(none).collect() == []


def check_packing(spark, texts, given, tokenizer):
    want = {i: np.array([*e.ids, 2], dtype="<u4") for i, e in enumerate(tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False))}
    rows = packing.pack(given, with_ids=True).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
        assert r.ids == want[r.doc_id][r.start : r.start + r.length].tolist()
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes())
        assert r.doc_tokens == len(want[r.doc_id])
    assert set(pieces) == set(want)
    for doc, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(want[doc])
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096 and at & (at - 1) == 0


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_packing_keeps_every_id(spark, tokenizer):
    texts = near_copies(bases=8) + ["word " * 9000]
    check_packing(spark, texts, docs(spark, texts), tokenizer)


def test_encoder_equals_the_tokenizer(tokenizer):
    texts = [
        "a<|endoftext|>b c <| d",
        "it's don't!! É. ÀB,, x1y2 a|b|> é Ĳa İx ﬁn ß ª",
        "x\u0085y z 　k ''s a's, it'S-x",
        "\n\n a\tb\r\nc",
        "say \"this\" (a) [b]: c;d e=f 1a2b a\x00b a\x1fb naïve, 'tis rock'n'roll a—b,c J\u030c j\u030c, a'\u0301s",
        "Σας ΣΑΣ, 中文。 日本 ①②",
        "re've 're . ... -- a.b.c U.S.A. l'été D'accord <|startoftext|>",
        *[t for t in ODD if t],
    ]
    own = packing.encoder(None)
    for _ in range(2):  # learned, then looked up
        ids = own.encode(packing.read_words([t.encode() for t in texts])).to_pylist()
        assert all(np.frombuffer(x, dtype="<u2")[-1] == 2 for x in ids)
        found = [np.frombuffer(x, dtype="<u2")[:-1].tolist() for x in ids]
        assert found == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_encoder_forgets_words_and_learns_them_again(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    own = packing.Encoder(None)
    for texts in (["One two three", "", "four's five. six"], ["seven one eight"], ["", ""], ["two Two TWO two, nine"], ["one two three four's"]):
        found = own.encode(packing.read_words([t.encode() for t in texts])).to_pylist()
        want = [[*e.ids, 2] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(x, dtype="<u2").tolist() for x in found] == want
    assert len(own.hash) <= 10


def test_hilbert_curve_visits_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 4, indexing="ij"), -1).reshape(-1, 4)
    keys = packing.hilbert(grid, 3)
    path = grid[np.argsort(keys)]
    assert sorted(keys.tolist()) == list(range(8**4))
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
