"""Exact quantiles of many columns without holding a column's values in one task.

``percentile`` keeps every distinct value of a column in one aggregate buffer.
Here a quantile is an order statistic found by narrowing: a mergeable sketch
gives a bracket around the wanted rank, counts make the bracket exact, and only
the values inside it are sorted.  Each round shrinks the bracket by three orders
of magnitude, so one round does for billions of rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwise.session import small_frame

ACCURACY = 10_000


@dataclass
class _Bracket:
    """Ranks ``first``..``last`` of ``column`` lie in [low, high]; ``below`` values are smaller."""

    column: str
    first: int
    last: int
    low: float
    high: float
    below: int
    inside: int
    few: bool = False
    margin: float = 2.0 / ACCURACY

    def within(self):
        c = F.col(self.column)
        return (c >= F.lit(self.low)) & (c <= F.lit(self.high))

    def ends(self) -> tuple[float, float]:
        """Shares of the values inside between which both ranks lie, with a margin."""
        low = (self.first - self.below) / self.inside - self.margin
        high = (self.last - self.below + 1) / self.inside + self.margin
        return max(0.0, low), min(1.0, high)


def _sketch(df: DataFrame, wide: list[_Bracket]) -> list[tuple[_Bracket, float, float]]:
    """Closer ends for the brackets that are too wide, from one pass.

    Brackets with the same column and range share a sketch.
    """
    shared: dict[tuple, list[_Bracket]] = {}
    for b in wide:
        shared.setdefault((b.column, b.low, b.high), []).append(b)
    sketches = [
        F.percentile_approx(
            F.when(group[0].within(), F.col(group[0].column).cast("double")),
            F.array(*[F.lit(q) for b in group for q in b.ends()]),
            ACCURACY,
        ).alias(f"q{i}")
        for i, group in enumerate(shared.values())
    ]
    found = df.agg(*sketches).first()
    tried: list[tuple[_Bracket, float, float]] = []
    for i, group in enumerate(shared.values()):
        for j, b in enumerate(group):
            tried.append((b, found[f"q{i}"][2 * j], found[f"q{i}"][2 * j + 1]))
    return tried


def _recount(df: DataFrame, tried: list[tuple[_Bracket, float, float]]) -> None:
    """Move brackets to the ends tried where a count shows that the ranks lie inside."""
    counts = []
    for i, (b, low, high) in enumerate(tried):
        c = F.col(b.column)
        counts.append(F.count_if(c < F.lit(low)).alias(f"b{i}"))
        counts.append(F.count_if((c >= F.lit(low)) & (c <= F.lit(high))).alias(f"n{i}"))
    row = df.agg(*counts).first()
    for i, (b, low, high) in enumerate(tried):
        below, inside = row[f"b{i}"], row[f"n{i}"]
        if below <= b.first and b.last < below + inside and inside < b.inside:
            b.low, b.high, b.below, b.inside = low, high, below, inside
        else:
            b.margin *= 4


def _select(df: DataFrame, brackets: list[_Bracket]) -> dict[tuple[str, int], float]:
    """Sort the values inside each bracket and pick the wanted ranks."""
    keys: dict[tuple, int] = {}
    for b in brackets:
        keys.setdefault((b.column, b.low, b.high), len(keys))
    candidates = [
        F.struct(F.lit(k).alias("key"), F.when(
            (F.col(c) >= F.lit(low)) & (F.col(c) <= F.lit(high)), F.col(c).cast("double")
        ).alias("v"))
        for (c, low, high), k in keys.items()
    ]
    inside = df.select(F.inline(F.array(*candidates))).filter(F.col("v").isNotNull())
    counted = inside.groupBy("key", "v").agg(F.count(F.lit(1)).alias("n"))
    run = Window.partitionBy("key").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("upto", F.sum("n").over(run))
    places = {
        (b.column, r): (keys[(b.column, b.low, b.high)], r - b.below)
        for b in brackets
        for r in (b.first, b.last)
    }
    # One row per wanted rank: at most two per quantile.
    asked = small_frame(df.sparkSession, sorted(set(places.values())), "key int, place bigint")
    covers = (F.col("upto") > F.col("place")) & (F.col("upto") - F.col("n") <= F.col("place"))
    rows = ranked.join(F.broadcast(asked), "key").filter(covers).collect()
    values = {(r["key"], r["place"]): r["v"] for r in rows}
    return {name: values[at] for name, at in places.items()}


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    max_sorted: int = 100_000,
    max_distinct: int = 50_000,
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation between order statistics; NULLs are skipped.

    A bracket is narrowed until it holds at most ``max_sorted`` values or a
    single distinct one.  A column of about ``max_distinct`` different values or
    fewer is not narrowed: its values are counted at once, in one more pass.
    """
    names = list(dict.fromkeys(columns))
    df = df.select(*names)
    # The first sketch goes with the counts: shares around the probabilities themselves.
    margin = 2.0 / ACCURACY
    shares = F.array(
        *[F.lit(q) for p in probabilities for q in (max(0.0, p - margin), min(1.0, p + margin))]
    )
    measures = (
        ("n", F.count), ("lo", F.min), ("hi", F.max),
        ("q", lambda c: F.percentile_approx(F.col(c).cast("double"), shares, ACCURACY)),
        ("d", F.approx_count_distinct),
    )
    known = df.agg(*[f(c).alias(f"{t}{i}") for i, c in enumerate(names) for t, f in measures]).first()
    brackets: dict[tuple[str, int, int], _Bracket] = {}
    guesses: dict[tuple[str, int, int], tuple[float, float]] = {}
    wanted: dict[str, list[tuple[int, int, float]]] = {c: [] for c in names}
    for i, c in enumerate(names):
        n = known[f"n{i}"]
        for j, p in enumerate(probabilities if n else ()):
            h = p * (n - 1)
            first, last = math.floor(h), math.ceil(h)
            wanted[c].append((first, last, h - first))
            low, high = float(known[f"lo{i}"]), float(known[f"hi{i}"])
            few = known[f"d{i}"] <= max_distinct
            brackets[(c, first, last)] = _Bracket(c, first, last, low, high, 0, n, few)
            guesses[(c, first, last)] = tuple(known[f"q{i}"][2 * j : 2 * j + 2])

    def too_wide(b: _Bracket) -> bool:
        return not b.few and b.inside > max_sorted and b.low < b.high and b.margin < 1

    first_try = [(b, *guesses[key]) for key, b in brackets.items() if too_wide(b)]
    if first_try:
        _recount(df, first_try)
    while wide := [b for b in brackets.values() if too_wide(b)]:
        _recount(df, _sketch(df, wide))
    values: dict[tuple[str, int], float] = {}
    rest = []
    for b in brackets.values():
        if b.low == b.high:
            values[(b.column, b.first)] = values[(b.column, b.last)] = b.low
        else:
            rest.append(b)
    if rest:
        values.update(_select(df, rest))
    return {
        c: [values[(c, a)] + (values[(c, b)] - values[(c, a)]) * f for a, b, f in wanted[c]]
        or [None] * len(probabilities)
        for c in names
    }


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int = ACCURACY
) -> dict[str, list[float | None]]:
    """One-pass quantiles with rank error at most rows / accuracy; opt-in."""
    probs = F.array(*[F.lit(float(p)) for p in probabilities])
    row = df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(c) for c in columns]
    ).first()
    return {c: list(row[c]) if row[c] is not None else [None] * len(probabilities) for c in columns}
