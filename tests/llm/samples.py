"""Small corpora with the odd cases every operator must take."""

from __future__ import annotations

import random

ODD = [None, "", " \n\t ", "a", "A", "x" * 3000, "é" * 700, "ab " * 900, "!!! ... ???", "Ünï \U0001f600 cödé\n\nend"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, part string, a long"


def rows(texts):
    """Documents with columns whose names the operators use for themselves."""
    out = []
    for i, t in enumerate(texts):
        source = None if i % 5 == 4 else f"s{i % 3}"
        out.append((i, t, None, source, len(t or ""), -1, -1.0, "own", 7))
    return out


def docs(spark, texts, parts=3):
    return spark.createDataFrame(rows(texts), SCHEMA).repartition(parts)


def near_copies(seed=3, bases=12, most=12):
    """Texts edited step by step, so that similarities lie on both sides of any limit."""
    rng = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(300)]
    line = [rng.choice(vocabulary) for _ in range(25)]
    out = []
    for _ in range(bases):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(2, 120))]
        for _ in range(rng.randrange(1, most)):
            words = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 12))):
                i = rng.randrange(len(words))
                kind = rng.random()
                if kind < 0.6:
                    words[i] = rng.choice(vocabulary)
                elif kind < 0.8:
                    words.insert(i, rng.choice(vocabulary))
                elif len(words) > 3:
                    del words[i]
            if rng.random() < 0.2:
                words = line + words
            out.append(" ".join(words))
            if rng.random() < 0.3:
                base = words
    return out + [t for t in ODD] + out[:3]
