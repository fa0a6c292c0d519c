"""Toxic passages by maximum-scoring segments.

A word is scored by the log-odds of toxic against clean labelled documents, with Dirichlet priors: the
prior count of a word is a fixed total dealt out by its frequency in both classes together. What is
counted is the word itself and its beginnings of 4 to 7 bytes (inflected forms share them), by 64-bit
hash, over all labelled documents. A word's score is the best lower bound among these, less a drift that
makes ordinary words negative; a word of no form above 0 scores ``LOWEST``. The model holds the forms above 0 alone: each
of them is in several toxic documents (three standard deviations below its log-odds is still above 0), so there
are at most as many as the words of all toxic labelled documents by that number, and few beside the vocabulary. One
scan over a text, linear in its words, finds all maximal segments (Ruzzo and Tompa). For segments of clean texts the scores follow an extreme-value law: its decay solves
sum p(s) exp(decay * s) = 1 over the word scores of clean documents, its offset is fitted to their best
segments. The normalised scores of the significant segments add up to a document's evidence, and a
logistic curve over the evidence of all labelled documents makes it a probability.

Null and empty texts have no segment and get the probability of no evidence. Without toxic or without
clean labels every score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidstrata.llm.common import ALNUM_WORDS, Words, as_bytes, groups, in_arrow, mix, powers
from vidstrata.session import estimated_bytes

STARTS = (4, 5, 6, 7)
HELD = 1 << 20  # so many counts a task adds up before it hands them on
PRIOR = 1.0  # total prior count of a word, in documents
CAUTION = 3.0  # lower bounds lie so many standard deviations below
DRIFT = 0.5
LOWEST = -1.0
LABELS_BROADCAST = 32 << 20
BIN = 0.25
EULER = 0.5772156649


def units(words: Words, at: np.ndarray) -> np.ndarray:
    """64-bit hashes of the counted forms of the words ``at``: the word, then its beginnings; 0 where it is shorter."""
    out = np.empty((len(STARTS) + 1, len(at)), dtype=np.uint64)
    out[0] = words.hash[at]
    start, sizes = words.start[at], words.end[at] - words.start[at]
    for k, length in enumerate(STARTS, start=1):
        total = np.zeros(len(sizes), dtype=np.uint64)
        long_enough = np.flatnonzero(sizes >= length)
        for j in range(length):
            total[long_enough] += ALNUM_WORDS[1][words.data[start[long_enough] + j]] * powers(16)[j]
        out[k] = np.where(sizes >= length, mix(total + np.uint64(k)), np.uint64(0))
    return out


@dataclass
class Model:
    forms: np.ndarray | None = None  # sorted hashes of the forms that score above 0
    scores: np.ndarray | None = None
    decay: float = 1.0
    offset: float = 0.0
    slope: float = 0.0
    bias: float = -20.0

    def __post_init__(self):
        if self.forms is not None:
            self.shift = np.uint64(64 - max(16, len(self.forms).bit_length() + 3))
            self.begins = np.zeros(1 << (64 - int(self.shift)), dtype=bool)  # by first bits, whether there is a form
            self.begins[self.forms >> self.shift] = True

    def form_scores(self, forms: np.ndarray) -> np.ndarray:
        out = np.full(forms.shape, np.float32(LOWEST))
        at = np.flatnonzero(self.begins[forms >> self.shift])
        own = forms.ravel()[at]
        place = np.minimum(np.searchsorted(self.forms, own), len(self.forms) - 1)
        known = self.forms[place] == own if len(own) else np.empty(0, dtype=bool)
        out.ravel()[at[known]] = self.scores[place[known]]
        return out

    def word_scores(self, words: Words) -> np.ndarray:
        if not len(words.hash):
            return np.empty(0, dtype=np.float32)
        _, first, word = np.unique(words.hash, return_index=True, return_inverse=True)
        scores = self.form_scores(units(words, first)).max(axis=0)[word]
        # the n-th time a text says a word counts 1 / n^2: repeated lines are no further evidence
        at = np.flatnonzero(scores > 0)
        order = np.lexsort((at, words.hash[at], words.doc[at]))
        word, doc = words.hash[at][order], words.doc[at][order]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        scores[at[order]] /= (np.arange(len(at)) - first + 1) ** 2
        return scores

    def segments(self, texts: list[bytes]):
        """Of each text: number of words, [(first word, end, normalised score)] of its segments."""
        for a, b in groups(texts):
            words = Words(texts[a:b], ALNUM_WORDS)
            scores = self.word_scores(words).astype(np.float64)
            total = np.concatenate([[0.0], np.cumsum(scores)])
            positive = np.flatnonzero(scores > 0)
            cut = np.searchsorted(positive, words.first_word)
            for i in range(b - a):
                first, n = int(words.first_word[i]), int(words.first_word[i + 1] - words.first_word[i])
                spans = maximal(positive[cut[i] : cut[i + 1]], total)
                level = self.offset + np.log(max(n, 1))
                yield n, [(s - first, e - first, self.decay * (total[e] - total[s]) - level) for s, e in spans]

    def evidence(self, n: int, spans: list[tuple[int, int, float]]) -> float:
        """The sum of significant segments, or the best one if none is."""
        best = max((x for _, _, x in spans), default=-self.offset - np.log(max(n, 1)))
        return best if best <= 0 else sum(x for _, _, x in spans if x > 0)

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * evidence + self.bias, -40, 40)))


def maximal(positive: np.ndarray, total: np.ndarray) -> list[tuple[int, int]]:
    """All maximal scoring segments, from the positions of positive scores and the running total.

    Each segment keeps the place of the nearest earlier one with less before it. A search for such a place follows
    these links, and whatever it passes over is never looked at again, so the scan is linear.
    """
    spans: list[tuple[int, int]] = []
    before: list[float] = []
    after: list[float] = []
    earlier: list[int] = []
    for p, left, right in zip(positive.tolist(), total[positive].tolist(), total[positive + 1].tolist(), strict=True):
        start, j = p, len(spans) - 1
        while True:
            while j >= 0 and before[j] >= left:
                j = earlier[j]
            if j < 0 or after[j] >= right:
                break
            # joined with that segment and all behind it
            start, left = spans[j][0], before[j]
            place, j = j, earlier[j]
            del spans[place:], before[place:], after[place:], earlier[place:]
        spans.append((start, p + 1))
        before.append(left)
        after.append(right)
        earlier.append(j)
    return spans


def lowered(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit(""))).cast("binary")


def labelled(docs: DataFrame, labels: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(text, toxic) of the documents with a label; a document labelled twice counts as its larger label."""
    own = labels.where("toxic IS NOT NULL").groupBy(F.col("doc_id").alias("of")).agg(F.max("toxic").alias("toxic"))
    size = estimated_bytes(labels)
    if size is not None and size <= LABELS_BROADCAST:
        own = F.broadcast(own)
    texts = docs.select(F.col(doc_id).alias("id"), lowered(F.col(text)).alias("text"))
    return texts.join(own, F.col("id") == F.col("of")).select("text", (F.col("toxic") > 0).alias("toxic"))


def counts(known: DataFrame) -> DataFrame:
    """(form, toxic documents, clean documents) of all forms of words; ``form`` has the bits of the hash."""

    def run(batches):
        import pyarrow as pa

        form, seen = np.empty(0, dtype=np.uint64), np.empty((2, 0), dtype=np.int64)
        new, kinds, held = [], [], 0

        def merge():
            every, at = np.unique(np.concatenate([form, *new]), return_inverse=True)
            total = np.zeros((2, len(every)), dtype=np.int64)
            total[:, at[: len(form)]] = seen
            kind = np.repeat(np.array(kinds, dtype=np.int64), [len(x) for x in new])
            for c in (0, 1):
                total[c] += np.bincount(at[len(form) :][kind == c], minlength=len(every))
            return every, total

        def rows():
            for c in range(0, len(form), 100_000):
                some = slice(c, c + 100_000)
                yield pa.RecordBatch.from_pydict({"form": form[some].view(np.int64), "bad": seen[1, some], "good": seen[0, some]})

        for batch in batches:
            texts, toxic = as_bytes(batch.column(0)), batch.column(1).to_pylist()
            for a, b in groups(texts):
                words = Words(texts[a:b], ALNUM_WORDS)
                _, first, word = np.unique(words.hash, return_index=True, return_inverse=True)
                forms = units(words, first)
                for i in range(b - a):
                    own = np.unique(forms[:, np.unique(word[words.first_word[i] : words.first_word[i + 1]])])
                    new.append(own[own > 0])
                    kinds.append(int(toxic[a + i]))
                    held += len(new[-1])
                if held > HELD:
                    form, seen = merge()
                    new, kinds, held = [], [], 0
                    if len(form) > HELD:
                        yield from rows()
                        form, seen = form[:0], seen[:, :0]
        form, seen = merge()
        yield from rows()

    rows = known.mapInArrow(run, "form bigint, bad bigint, good bigint")
    return rows.groupBy("form").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def log_odds(bad: np.ndarray, good: np.ndarray, bad_docs: int, good_docs: int) -> np.ndarray:
    """The scores of forms by their counts: a lower bound of the log-odds, less the drift."""
    seen = bad + good
    rate = (seen + 0.5) / (bad_docs + good_docs + 1)
    prior_bad = PRIOR * bad_docs / (bad_docs + good_docs)
    prior_good = PRIOR - prior_bad
    a, b = bad + prior_bad, good + prior_good
    odds = np.log(a / (bad_docs + PRIOR)) - np.log(b / (good_docs + PRIOR))
    spread = np.sqrt(1 / a + 1 / b)
    score = odds - CAUTION * spread - DRIFT
    # a word in most documents tells little, however sure its log-odds are
    return np.where(rate < 0.5, score, np.minimum(score, -DRIFT)).astype(np.float32)


def scored_forms(known: DataFrame, bad_docs: int, good_docs: int) -> pd.DataFrame:
    """(form, score) of all forms that score above 0; the others have ``LOWEST``."""

    def work(batch):
        form, bad, good = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        score = log_odds(bad, good, bad_docs, good_docs)
        kept = score > 0
        yield {"form": form[kept], "score": score[kept]}

    return in_arrow(counts(known), work, "form bigint, score float").toPandas()


def histogram(known: DataFrame, bins_of) -> pd.DataFrame:
    """(toxic, bin, n) of the numbers ``bins_of`` gives for (texts, toxic)."""

    def work(batch):
        texts, toxic = as_bytes(batch.column(0)), np.array(batch.column(1).to_pylist(), dtype=bool)
        owner, values = bins_of(texts)
        bins = np.round(np.clip(values, -200, 2000) / BIN).astype(np.int64)
        key, n = np.unique(bins * 2 + toxic[owner], return_counts=True)
        yield {"toxic": key % 2 == 1, "bin": key // 2, "n": n}

    rows = in_arrow(known, work, "toxic boolean, bin bigint, n bigint")
    return rows.groupBy("toxic", "bin").agg(F.sum("n").alias("n")).toPandas()


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """The model of ``labels`` (doc_id, toxic); give only the documents it may learn from."""
    known = labelled(docs, labels, doc_id, text)
    size = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    bad, good = size.get(True, 0), size.get(False, 0)
    if not bad or not good:
        share = bad / max(bad + good, 1)
        return Model(bias=float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    kept = scored_forms(known, bad, good)
    forms = kept["form"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(forms)
    model = Model(forms=forms[order], scores=kept["score"].to_numpy(dtype=np.float32)[order])

    def by_word(texts):
        owners, scores = [], []
        for a, b in groups(texts):
            words = Words(texts[a:b], ALNUM_WORDS)
            owners.append(words.doc + a)
            scores.append(model.word_scores(words))
        return np.concatenate(owners or [np.empty(0, int)]), np.concatenate(scores or [np.empty(0)])

    def by_best(texts):
        best = [max((x for _, _, x in spans), default=-np.log(max(n, 1))) for n, spans in model.segments(texts)]
        return np.arange(len(texts)), np.array(best)

    def by_evidence(texts):
        found = [model.evidence(n, spans) for n, spans in model.segments(texts)]
        return np.arange(len(texts)), np.array(found)

    clean = known.where("NOT toxic")
    model.decay = extreme_decay(histogram(clean, by_word))
    best = histogram(clean, by_best)
    model.offset = float((best["bin"] * BIN * best["n"]).sum() / best["n"].sum()) - EULER
    model.slope, model.bias = logistic(histogram(known, by_evidence))
    return model


def extreme_decay(scores: pd.DataFrame) -> float:
    """The positive root of sum p(s) exp(decay * s) = 1, within 0.1 to 5."""
    if scores.empty:
        return 1.0
    s, p = scores["bin"].to_numpy() * BIN, scores["n"].to_numpy() / scores["n"].sum()
    low, high = 0.1, 5.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (p * np.exp(middle * s)).sum() < 1 else (low, middle)
    return low


def logistic(found: pd.DataFrame) -> tuple[float, float]:
    """Slope and bias over the binned evidence, by Newton steps with a slight pull to 0; slope at least 0."""
    x, y, n = found["bin"].to_numpy() * BIN, found["toxic"].to_numpy(dtype=float), found["n"].to_numpy(dtype=float)
    x = np.clip(x, -50, 50)
    design = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        pull = np.array([1e-3, 1e-3])
        gradient = design.T @ (n * (y - p)) - pull * w
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + np.diag(pull) + 1e-9 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w = w + step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return (float(w[0]), float(w[1])) if w[0] > 0 else (0.0, float(w[1]))


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with a struct ``into``: score, evidence, and the significant passages as word ranges."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, evidence double, passages array<struct<first: int, end: int, score: double>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        own = shared.value
        if own.forms is None:
            found = [(0.0, [])] * len(texts)
        else:
            found = [(own.evidence(n, spans), [x for x in spans if x[2] > 0]) for n, spans in own.segments(list(texts))]
        evidence = np.array([e for e, _ in found], dtype=float)
        passages = [[{"first": a, "end": b, "score": float(x)} for a, b, x in p] for _, p in found]
        return pd.DataFrame({"score": own.probability(np.clip(evidence, -50, 50)), "evidence": evidence, "passages": passages})

    return docs.withColumn(into, run(lowered(F.col(text))))
