"""Mixing sources to target weights by entropy balancing.

Every document gets the rate nearest to one copy (in Kullback-Leibler distance, rates at most
``most``) under which each source holds its target number of words. The dual has one multiplier per
source; at its solution a document's rate is ``exp(multiplier * size / mean size)``, so the rates are
exponentially tilted by size. The multipliers come from Newton steps on the logarithm of the tilted
sums, kept inside a bracket. Each step is one aggregation over the (source, size) counts, for all
sources at once. Rates become whole copies: the whole part of the rate, and one more copy for the
documents whose fraction beats their own number by most, until the target is met. The number comes from
the hash of doc_id and text; rows of a source that agree in both have numbers at even distances.

Only DataFrame operations. Null texts have size 0, a null source is a source of its own, repeated rows
count each, an empty table gives an empty result. Result columns replace input columns of their name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vidstrata.llm.common import apart, stored

WORD = r"[^\x20\x09-\x0D]+"
RESULT = ("size", "source_size", "target", "rate", "copies", "taken")
NEWTON_STEPS = 60
TOLERANCE = 1e-9
BINS = 1024
LEVELS = 3
PIECE = 50_000  # rows of a group that agree in all are numbered in pieces of so many


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """Of (source, source_size, documents) each source's target; one row per source.

    With targets min(most * size, weight * level), the level follows from running sums in the order
    of most * size / weight. The two windows run over one row per source.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.array(*[F.lit(float(w)) for w in weights])
    cap = F.col("source_size") * F.lit(float(most))
    before = W.orderBy("full_at", F.col("source").asc_nulls_last())
    before = before.rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    ranked = (
        sizes.withColumn("n", (F.row_number().over(by_name) - 1) % len(weights))
        .withColumn("weight", weight[F.col("n")])
        .withColumn("cap", cap)
        .withColumn("full_at", F.col("cap") / F.col("weight"))
        .withColumn("own_level", level)
    )
    full = F.col("full_at") <= F.col("own_level")
    common = F.max(F.when(~full, F.col("own_level"))).over(every)
    return ranked.withColumn(
        "target", F.when(full, F.col("cap")).otherwise(F.col("weight") * common)
    ).select("source", "source_size", "documents", "target")


def tilted(most: float) -> Column:
    """The rate of a document of ``size`` in a source with multiplier ``tilt``."""
    return F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(math.log(most))))


def solve(counts: DataFrame, goal: DataFrame, most: float) -> DataFrame:
    """``goal`` with each source's multiplier, from (source, size, n) counts."""
    s, t = F.col("source_size"), F.col("target")
    log_most = math.log(most)
    mean = F.when(s > 0, s / F.col("documents")).otherwise(1.0)
    start = F.coalesce(F.ln(F.try_divide(t, s)), F.lit(0.0))
    state = goal.withColumn("mean", mean).withColumn("start", start)
    state = state.select(
        "source",
        "source_size",
        "target",
        "mean",
        F.when(s == 0, 0.0).when(t >= s * most * (1 - 1e-12), F.col("mean") * log_most)
        .otherwise(F.col("start")).alias("tilt"),
        # all documents are longer than no word, which bounds the multiplier on both sides
        F.when(t < s, F.col("mean") * F.col("start")).otherwise(0.0).alias("low"),
        F.when(t > s, F.col("mean") * log_most).otherwise(0.0).alias("high"),
        ((s == 0) | (t >= s * most * (1 - 1e-12))).alias("done"),
    )
    state = stored(state, "mix-state")
    counts = counts.where("size > 0").withColumnRenamed("source", "of")
    rate = tilted(most)
    words = F.col("n") * F.col("size")
    slope = F.when(F.col("tilt") * F.col("size") / F.col("mean") < log_most, words * F.col("size") / F.col("mean") * rate)
    for _ in range(NEWTON_STEPS):
        # a handful of rows of the same table decide whether to go on
        if state.where("NOT done").isEmpty():
            break
        sums = (
            counts.join(state.where("NOT done"), F.col("of").eqNullSafe(F.col("source")))
            .groupBy("of")
            .agg(F.sum(words * rate).alias("got"), F.sum(slope).alias("slope"))
        )
        both = state.join(sums, F.col("of").eqNullSafe(F.col("source")), "left")
        near = F.coalesce(F.abs(F.col("got") - t) <= t * TOLERANCE, F.lit(True))
        both = both.withColumn("low", F.when(F.col("got") < t, F.col("tilt")).otherwise(F.col("low")))
        both = both.withColumn("high", F.when(F.col("got") > t, F.col("tilt")).otherwise(F.col("high")))
        step = F.col("tilt") + F.ln(F.try_divide(t, F.col("got"))) * F.try_divide(F.col("got"), F.col("slope"))
        inside = (step > F.col("low")) & (step < F.col("high"))
        narrow = (F.col("high") - F.col("low")) <= 1e-13 * (F.abs(F.col("high")) + F.abs(F.col("low")))
        state = both.select(
            "source",
            "source_size",
            "target",
            "mean",
            F.when(near, F.col("tilt"))
            .when(inside, step)
            .otherwise((F.col("low") + F.col("high")) / 2)
            .alias("tilt"),
            "low",
            "high",
            (near | narrow).alias("done"),
        )
        state = stored(state, "mix-state")
    return state.select("source", "source_size", "target", "mean", "tilt")


def rounding(groups: DataFrame, state: DataFrame, most: float) -> DataFrame:
    """``state`` with each source's limit: one more copy goes to documents whose lead is at least that.

    The lead lies in (-1, 1). Sums by lead find the bin in which the target is met, then a bin of that
    bin, and so on; a document is the error at most, but for those that tie in lead to 30 bits.
    ``groups`` has (of, size, chance, n); a group of more rows than bins is counted by bin.
    """
    docs = groups.join(state, F.col("of").eqNullSafe(F.col("source")))
    docs = docs.where("size > 0").withColumn("rate", tilted(most))
    docs = docs.withColumn("fraction", F.col("rate") - F.floor("rate"))
    whole = F.floor("rate") * F.col("size") * F.col("n")
    limits = (
        docs.groupBy("source")
        .agg(F.sum(whole).alias("whole"), F.first("target").alias("target"))
        .select("source", (F.col("target") - F.col("whole")).alias("missing"), F.lit(-1.0).alias("from_"))
    )
    limits = stored(limits, "mix-limits")
    docs = docs.where(F.floor("rate") < most).select("of", "size", "n", "fraction", number("chance").alias("number"))
    above = W.partitionBy("source").orderBy(F.col("bin").desc())
    width = 2.0
    for level in range(LEVELS):
        width /= BINS
        ahead = F.col("fraction") - F.col("from_")
        own = F.when(F.col("n") == 1, F.array(F.floor((ahead - F.col("number")) / width)))
        own = own.when(
            F.col("n") <= BINS,
            F.transform(
                F.sequence(F.lit(0).cast("long"), F.col("n") - 1),
                lambda j: F.floor((ahead - (F.col("number") + j) / F.col("n")) / F.lit(width)),
            ),
        ).otherwise(F.sequence(F.lit(0).cast("long"), F.lit(BINS - 1).cast("long")))
        low = ahead - F.col("bin") * width
        rows = F.when(F.col("n") <= BINS, F.lit(1).cast("long")).otherwise(beyond(low) - beyond(low - width))
        bins = (
            docs.join(limits, F.col("of").eqNullSafe(F.col("source")))
            .withColumn("bin", F.explode(own))
            .where(F.col("bin").between(0, BINS - 1))
            .groupBy("source", "missing", "from_", "bin")
            .agg(F.sum(F.col("size") * rows).alias("in_bin"))
            .withColumn("with_bin", F.sum("in_bin").over(above))
        )
        # the highest bin that reaches what is missing; none: all bins are needed
        met = bins.where("with_bin >= missing").groupBy("source").agg(
            F.max(F.struct("bin", "with_bin", "in_bin")).alias("m")
        ).withColumnRenamed("source", "of_source")
        last = level == LEVELS - 1
        overshoot = F.col("m.with_bin") - F.col("missing")
        undershoot = F.col("missing") - (F.col("m.with_bin") - F.col("m.in_bin"))
        leave = F.when(F.lit(last) & (undershoot < overshoot), 1).otherwise(0)
        start = F.col("from_") + (F.coalesce(F.col("m.bin") + leave, F.lit(0))) * width
        limits = limits.join(met, F.col("source").eqNullSafe(F.col("of_source")), "left").select(
            "source",
            (F.col("missing") - F.coalesce(F.col("m.with_bin") - F.col("m.in_bin"), F.lit(0))).alias("missing"),
            start.alias("from_"),
        )
        limits = stored(limits, "mix-limits")
    limits = limits.select(F.col("source").alias("of_source"), F.col("from_").alias("limit"))
    return state.join(limits, F.col("source").eqNullSafe(F.col("of_source")), "left").drop("of_source")


def number(chance: str) -> Column:
    """A document's own number in [0, 1), the same at every run. Row j of a group has (number + j) / n.

    A document's lead is the fraction of its rate less its number.
    """
    return F.pmod(F.col(chance), F.lit(1 << 52)) / float(1 << 52)


def beyond(ahead: Column, n: str = "n", own: str = "number") -> Column:
    """How many of a group's ``n`` numbers are at most ``ahead``."""
    return F.greatest(F.least(F.floor(ahead * F.col(n) - F.col(own)) + 1, F.col(n)), F.lit(0).cast("long"))


def extra_copies(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with ``__extra``: whether the row gets one more copy.

    Rows alone with their key have their lead to go by. Of the others, a group's first rows get the extra
    copies. They are written down with a piece each, so that no group is numbered in one task.
    """
    ahead = F.col("__rate") - F.floor("__rate") - F.col("__own.limit")
    ties = groups.where("n > 1")
    if ties.isEmpty():
        return rows.withColumn("__extra", ahead >= number("__chance"))
    ties = ties.select(*[F.col(c).alias(f"__tie_{c}") for c in ties.columns])
    rows = rows.withColumn("__piece", F.floor(F.monotonically_increasing_id() / PIECE))
    same = F.col("__of").eqNullSafe(F.col("__tie_of"))
    same &= (F.col("__size") == F.col("__tie_size")) & (F.col("__chance") == F.col("__tie_chance"))
    alone = rows.join(ties, same, "left_anti").withColumn("__extra", ahead >= number("__chance"))
    many = stored(rows.join(ties, same).drop("__tie_of", "__tie_size", "__tie_chance"), "mix-ties")
    key = ["__of", "__size", "__chance"]
    pieces = many.groupBy(*key, "__piece").agg(F.count("*").alias("__rows"))
    before = W.partitionBy(*key).orderBy("__piece").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.select(
        *[F.col(c).alias(f"{c}_p") for c in (*key, "__piece")], F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before")
    )
    same = F.col("__of").eqNullSafe(F.col("__of_p"))
    for c in (*key[1:], "__piece"):
        same &= F.col(c) == F.col(f"{c}_p")
    many = many.withColumn("__at", F.row_number().over(W.partitionBy(*key, "__piece").orderBy("__piece"))).join(pieces, same)
    many = many.withColumn("__number", number("__chance"))
    many = many.withColumn("__extra", F.col("__before") + F.col("__at") <= beyond(ahead, "__tie_n", "__number"))
    return alone.unionByName(many.select(*alone.columns))


@apart
def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (1, 2, 3),
    most: float = 3,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``docs`` with size, source_size, target, rate, copies and taken (words of all copies)."""
    chance = F.xxhash64(F.col(doc_id), F.col(text))
    sized = docs.select(
        F.col(source).alias("of"),
        word_count(F.col(text)).alias("size"),
        chance.alias("chance"),
    )
    groups = stored(sized.groupBy("of", "size", "chance").agg(F.count("*").alias("n")), "mix-groups")
    counts = stored(groups.groupBy(F.col("of").alias("source"), "size").agg(F.sum("n").alias("n")), "mix-counts")
    sizes = counts.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("documents")
    )
    goal = stored(targets(sizes, weights, most), "mix-goal")
    state = solve(counts, goal, most)
    solved = stored(rounding(groups, state, most), "mix-solved")
    names = {c: f"solved_{c}" for c in solved.columns}
    solved = solved.select(*[F.col(c).alias(names[c]) for c in solved.columns])
    own = F.struct(
        F.col("solved_source_size").alias("source_size"),
        F.col("solved_target").alias("target"),
        F.col("solved_mean").alias("mean"),
        F.col("solved_tilt").alias("tilt"),
        F.col("solved_limit").alias("limit"),
    )
    kept = [c for c in docs.columns if c not in RESULT]
    joined = docs.select(
        *kept, F.col(source).alias("__of"), word_count(F.col(text)).alias("__size"), chance.alias("__chance")
    )
    joined = joined.join(solved, F.col("__of").eqNullSafe(F.col("solved_source"))).withColumn("__own", own)
    joined = joined.select(*kept, "__of", "__size", "__chance", "__own")
    size = F.col("__size")
    power = F.col("__own.tilt") * size / F.col("__own.mean")
    rate = F.when(size > 0, F.exp(F.least(power, F.lit(math.log(most))))).otherwise(F.lit(1.0))
    joined = extra_copies(joined.withColumn("__rate", rate), groups)
    extra = (size > 0) & (F.floor("__rate") < most) & F.col("__extra")
    copies = (F.floor("__rate") + F.when(extra, 1).otherwise(0)).cast("int")
    return joined.withColumn("__copies", copies).select(
        *kept,
        size.alias("size"),
        F.col("__own.source_size").alias("source_size"),
        F.col("__own.target").alias("target"),
        F.col("__rate").alias("rate"),
        F.col("__copies").alias("copies"),
        (F.col("__copies") * size).cast("long").alias("taken"),
    )


@apart
def mixed(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; the columns of ``docs``."""
    how = {"doc_id": "doc_id", "text": "text", "source": "source"} | how
    aside = {c: f"__kept_{c}" for c in docs.columns if c in RESULT}
    taken = mix(docs.withColumnsRenamed(aside), **{k: aside.get(v, v) if isinstance(v, str) else v for k, v in how.items()})
    rows = taken.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])
