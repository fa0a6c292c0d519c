"""Mergeable partial aggregates.

Each kind gives three column expressions: ``partial`` over raw values, ``merge`` over stored
states, and ``final`` from one state to the reported value. Merging is associative, so states from
any number of loads add up to the one-pass result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vidstrata.schemas import SKETCH_LG_K


class Max:
    @staticmethod
    def partial(value: Column) -> Column:
        return F.max(value)

    merge = partial

    @staticmethod
    def final(state: Column) -> Column:
        return state

    @classmethod
    def exact(cls, value: Column) -> Column:
        return cls.final(cls.partial(value))


class Sum(Max):
    @staticmethod
    def partial(value: Column) -> Column:
        return F.sum(value)

    merge = partial


class Count(Max):
    @staticmethod
    def partial(value: Column) -> Column:
        return F.count(value)

    @staticmethod
    def merge(state: Column) -> Column:
        return F.sum(state)


class Mean(Max):
    @staticmethod
    def partial(value: Column) -> Column:
        return F.struct(F.sum(value.cast("double")).alias("total"), F.count(value).alias("n"))

    @staticmethod
    def merge(state: Column) -> Column:
        return F.struct(
            F.sum(state.getField("total")).alias("total"), F.sum(state.getField("n")).alias("n")
        )

    @staticmethod
    def final(state: Column) -> Column:
        return F.try_divide(state.getField("total"), state.getField("n"))


class Distinct(Max):
    """Approximate in state form (a sketch of fixed size), exact in one pass."""

    @staticmethod
    def partial(value: Column) -> Column:
        return F.hll_sketch_agg(value, F.lit(SKETCH_LG_K))

    @staticmethod
    def merge(state: Column) -> Column:
        return F.hll_union_agg(state)

    @staticmethod
    def final(state: Column) -> Column:
        return F.hll_sketch_estimate(state)

    @staticmethod
    def exact(value: Column) -> Column:
        return F.count_distinct(value)
