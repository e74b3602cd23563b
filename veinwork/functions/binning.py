"""Bins over numeric columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds (inclusive) and labels of the two coarse bins.
AGE_STEPS = (((3, "New"), (7, "Recent"), (15, "Middle")), "Old")
HOUR_STEPS = (((6, "Night"), (12, "Morning"), (18, "Afternoon")), "Evening")

# Edges and labels of the age cut.
AGE_EDGES = (-1, 3, 7, 15, 50)
AGE_LABELS = ("New", "Recent", "Middle", "Old")


def step_label(value: Column, steps: Sequence[tuple[float, str]], last: str) -> Column:
    """First step whose upper bound holds the value; above all steps, or null, is `last`."""
    chain = F
    for bound, label in steps:
        chain = chain.when(value <= bound, label)
    return chain.otherwise(last)


def cut_label(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed intervals; a value outside all of them, or null, is null."""
    chain = F
    for low, high, label in zip(edges, edges[1:], labels):
        chain = chain.when((value > low) & (value <= high), label)
    return chain


def interval_code(value: Column, edges: Sequence[float]) -> Column:
    """Number of the right-closed interval between rising edges, lowest edge included."""
    inner = edges[1:-1]
    code = F.lit(0)
    for edge in inner:
        code = code + (value > F.lit(edge)).cast("int")
    return F.when((value >= F.lit(edges[0])) & (value <= F.lit(edges[-1])), code)
