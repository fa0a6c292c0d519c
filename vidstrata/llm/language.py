"""Language identification by hierarchical discrimination.

A text is first given to a language family; within it one-versus-one linear support vector machines
tell the related languages apart. Features are hashed byte trigrams of the whole lower-case text
(square roots of counts, scaled to length 1). Both levels vote pair by pair; ties go to the larger sum
of margins, then to the smaller name. The score is the share of belief in the family times that in the
language, from margins scaled to fit the training rows.

Fitted on the driver on at most ``SAMPLE_ROWS`` labelled rows (but 20 per language at least), chosen by
a hash of the id; only fixed-length feature vectors leave the executors. Null texts and texts without
a letter are ``und`` with score 0, and so is everything if no row is labelled.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidstrata.llm.common import apart, groups

SAMPLE_ROWS = 2000
DIMENSIONS = 4096
UNDETERMINED = "und"

# Language families by ISO 639-1 code. A language not listed is a family of its own.
FAMILIES = {
    "romance": "ca es fr gl it oc pt ro",
    "germanic": "af da de en fy is lb nl nb nn no sv yi",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt ug uz",
    "indo-iranian": "bn fa gu hi ku mr ne pa ps ur",
    "semitic": "am ar he mt",
}


def family_of(lang: str) -> str:
    return next((name for name, codes in FAMILIES.items() if lang in codes.split()), lang)


def features(texts: list[bytes]) -> np.ndarray:
    """One row for each text: square roots of hashed trigram counts, of length 1."""
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    for a, b in groups(texts):
        for c in range(a, b, 256):
            part = [b" " + t + b" " for t in texts[c : min(c + 256, b)]]
            data = np.frombuffer(b"".join(part), dtype=np.uint8).astype(np.uint32)
            row = np.repeat(np.arange(len(part)), [len(t) for t in part])
            code = data[:-2] | (data[1:-1] << np.uint32(8)) | (data[2:] << np.uint32(16))
            slot = (code * np.uint32(2654435761)) >> np.uint32(20)
            inside = row[:-2] == row[2:]
            at = row[:-2][inside] * DIMENSIONS + slot[inside]
            counts = np.bincount(at, minlength=len(part) * DIMENSIONS)
            out[c : c + len(part)] = np.sqrt(counts.reshape(len(part), DIMENSIONS))
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    return out


@dataclass
class Machine:
    """Which of two classes: the first at positive margins."""

    first: str
    second: str
    weights: np.ndarray
    bias: float
    scale: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + np.float32(self.bias)


def fit_machine(first: str, second: str, x: np.ndarray, y: np.ndarray, steps: int = 200, decay: float = 1e-4) -> Machine:
    """Linear SVM with squared hinge loss, by accelerated gradient steps; y is 1 or -1, classes weigh alike."""
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w = v = np.zeros(x.shape[1], dtype=np.float32)
    b = c = 0.0
    rate = 1 / (4 + decay)
    for step in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v + np.float32(c))) * y * weight
        new, shift = v + rate * (2 * (slack @ x) - decay * v), c + rate * 2 * float(slack.sum())
        momentum = step / (step + 3)
        v, c = new + momentum * (new - w), shift + momentum * (shift - b)
        w, b = new, shift
    machine = Machine(first, second, w, b, 1.0)
    margins = y * machine.margin(x)
    loss = {s: float((weight * np.log1p(np.exp(-np.clip(s * margins, -30, 30)))).sum()) + 1e-4 * s for s in (1, 2, 4, 8, 16)}
    machine.scale = min(loss, key=loss.get)
    return machine


def beliefs(names: list[str], machines: list[Machine], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the winner in ``names`` and the belief in it, for each row."""
    votes, sums, logs = (np.zeros((len(x), len(names))) for _ in range(3))
    at = {name: i for i, name in enumerate(names)}
    for machine in machines:
        m = machine.margin(x)
        i, j = at[machine.first], at[machine.second]
        votes[:, i] += m >= 0
        votes[:, j] += m < 0
        sums[:, i] += m
        sums[:, j] -= m
        p = 1 / (1 + np.exp(-np.clip(machine.scale * m, -30, 30)))
        logs[:, i] += np.log(p + 1e-12)
        logs[:, j] += np.log(1 - p + 1e-12)
    best = votes == votes.max(axis=1, keepdims=True)
    winner = np.where(best, sums, -np.inf).argmax(axis=1)
    shares = np.exp(logs - logs.max(axis=1, keepdims=True))
    shares /= shares.sum(axis=1, keepdims=True)
    return winner, shares[np.arange(len(x)), winner]


@dataclass
class Model:
    families: list[str] = field(default_factory=list)
    members: dict[str, list[str]] = field(default_factory=dict)
    between: list[Machine] = field(default_factory=list)
    within: dict[str, list[Machine]] = field(default_factory=dict)

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        if not self.families:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        x = features(texts)
        family, belief = beliefs(self.families, self.between, x)
        names, scores = [""] * len(texts), np.zeros(len(texts))
        for f, name in enumerate(self.families):
            rows = np.flatnonzero(family == f)
            if len(rows):
                language, share = beliefs(self.members[name], self.within[name], x[rows])
                scores[rows] = belief[rows] * share
                for row, i in zip(rows, language, strict=True):
                    names[row] = self.members[name][i]
        return names, scores


def lowered(text: Column) -> Column:
    return F.lower(text).cast("binary")


def _pairs(names: list[str], labels: np.ndarray, x: np.ndarray) -> list[Machine]:
    out = []
    for first, second in combinations(names, 2):
        rows = (labels == first) | (labels == second)
        out.append(fit_machine(first, second, x[rows], np.where(labels[rows] == first, 1, -1).astype(np.float32)))
    return out


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = SAMPLE_ROWS) -> Model:
    """The model of the labelled rows given (null labels and texts are left out)."""
    known = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(lang).count().collect()}  # a row per language
    if not counts:
        return Model()
    each = max(rows // len(counts), 20)
    chance = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for name, count in counts.items():
        share = F.when(F.col(lang) == name, min(1.0, 1.5 * each / count)).otherwise(share)

    @F.pandas_udf("binary")
    def vectors(texts: pd.Series) -> pd.Series:
        return pd.Series([v.tobytes() for v in features(list(texts))])

    drawn = known.where(chance < share).select(F.col(lang).alias("lang"), chance.alias("chance"), lowered(F.col(text)).alias("text"))
    drawn = drawn.select("lang", "chance", vectors("text").alias("vector")).toPandas()
    drawn = drawn.sort_values("chance").groupby("lang").head(each)
    if drawn.empty:
        return Model()
    x = np.stack([np.frombuffer(v, dtype=np.float32) for v in drawn["vector"]])
    labels = drawn["lang"].to_numpy(dtype=object)
    family = np.array([family_of(name) for name in labels], dtype=object)
    model = Model(families=sorted(set(family)))
    model.between = _pairs(model.families, family, x)
    for name in model.families:
        model.members[name] = sorted(set(labels[family == name]))
        model.within[name] = _pairs(model.members[name], labels, x)
    return model


@apart
def detect(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct ``into`` of lang_pred and score (an input column of that name is replaced)."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        names, scores = model.predict(list(texts))
        return pd.DataFrame({"lang_pred": names, "score": scores})

    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    # the function sees an empty text where the answer is known without it
    guess = predict(F.when(has_letter, lowered(F.col(text))).otherwise(F.lit(b"")))
    unknown = F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    return docs.withColumn("__guess", guess).withColumn(into, F.when(has_letter, F.col("__guess")).otherwise(unknown)).drop("__guess")
