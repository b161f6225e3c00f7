"""Parameter search that learns from the trials so far and stops poor ones early.

A study is a table of trials.  The next parameters come from two densities per parameter,
one over the better trials and one over the others (Bergstra et al., "Algorithms for
Hyper-Parameter Optimization", 2011): of some draws from the first, the one that is likeliest
under it against the second.  The same table, number and seed give the same proposal.

While it runs a trial reports values by step.  A rule compares each with what earlier trials
had at that step; a trial that it stops is kept with the state PRUNED.  Steps are growing
shares of the rows, so most trials only ever see few of them.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Mapping, Sequence
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.functions.scalar import hash_uniform
from panelwise.operators.counts import cv_summary
from panelwise.operators.split import stratified_folds
from panelwise.plans.training import _CONDITIONAL, _REFUSALS, CV_METRICS, SEARCH_SPACES, SEED, cross_validate
from panelwise.roles import ColumnRoles
from panelwise.session import materialize, path_exists

#: Trials drawn at random first, draws that a proposal is chosen from, the share and the most of the better trials.
STARTUP, DRAWS, BETTER_SHARE, MOST_BETTER = 10, 24, 0.1, 25
#: Latest trials that a proposal looks at.
MAX_TRIALS = 10_000
STUDY_SCHEMA = "number int, state string, value double, params map<string,string>, steps array<double>, metrics map<string,double>"

Rule = Callable[[int, float, list[list[float]]], bool]


class Pruned(Exception):
    """A trial was stopped by the rule."""


def median_rule(startup: int = 5, warmup: int = 10) -> Rule:
    """Stop a trial below the median of the earlier ones at its step, after some trials and steps."""

    def stop(step: int, value: float, earlier: list[list[float]]) -> bool:
        there = [steps[step] for steps in earlier if len(steps) > step]
        return len(earlier) >= startup and step >= warmup and bool(there) and value < float(np.median(there))

    return stop


def halving_rule(factor: int = 3, startup: int = 0) -> Rule:
    """Stop a trial that is not among the best 1 / ``factor`` of those that came to its step, itself included."""

    def stop(step: int, value: float, earlier: list[list[float]]) -> bool:
        there = sorted([steps[step] for steps in earlier if len(steps) > step] + [value], reverse=True)
        return len(earlier) >= startup and value < there[max(math.ceil(len(there) / factor), 1) - 1]

    return stop


class _Density:
    """A mixture over [low, high]: one normal per observation, cut off at the ends, and a wide one for all that is not known."""

    def __init__(self, seen: Sequence[float], low: float, high: float):
        self.low, self.high = low, high
        width = high - low
        center = np.append(np.asarray(seen, float), (low + high) / 2)
        order = np.argsort(center, kind="stable")
        sorted_ = np.concatenate([[low], center[order], [high]])
        gap = np.empty(len(center))
        gap[order] = np.maximum(np.diff(sorted_)[:-1], np.diff(sorted_)[1:])
        spread = np.clip(gap, width / min(100, 1 + len(center)), width)
        spread[-1] = width
        self.center, self.spread = center, spread

    def _mass(self, z: np.ndarray) -> np.ndarray:
        return 0.5 * (1 + np.vectorize(math.erf)(z / math.sqrt(2)))

    def draw(self, rng: np.random.Generator, count: int) -> np.ndarray:
        out = np.empty(count)
        for i in range(count):
            which = rng.integers(len(self.center))
            value = rng.normal(self.center[which], self.spread[which])
            for _ in range(50):
                if self.low <= value <= self.high:
                    break
                value = rng.normal(self.center[which], self.spread[which])
            out[i] = min(max(value, self.low), self.high)
        return out

    def log(self, x: np.ndarray) -> np.ndarray:
        z = (x[:, None] - self.center) / self.spread
        inside = self._mass((self.high - self.center) / self.spread) - self._mass((self.low - self.center) / self.spread)
        dense = np.exp(-0.5 * z * z) / (self.spread * math.sqrt(2 * math.pi) * np.maximum(inside, 1e-12))
        return np.log(np.maximum(dense.mean(axis=1), 1e-300))


def _read(text: str | None, kind: str, choices: Sequence) -> Any:
    if kind == "choice":
        return next((c for c in choices if (None if c is None else str(c)) == text), None)
    return None if text is None else int(text) if kind == "int" else float(text)


def _numeric(name: str, kind: str, bounds: Sequence[float], better: list[dict], others: list[dict], rng: np.random.Generator) -> Any:
    low, high = (float(b) for b in bounds)
    if kind == "log":
        low, high = math.log(low), math.log(high)
    if kind == "int":
        low, high = low - 0.5, high + 0.5
    scale = math.log if kind == "log" else float
    sides = [_Density([scale(p[name]) for p in side if p.get(name) is not None], low, high) for side in (better, others)]
    drawn = sides[0].draw(rng, DRAWS)
    best = float(drawn[int(np.argmax(sides[0].log(drawn) - sides[1].log(drawn)))])
    if kind == "int":
        return int(min(max(round(best), bounds[0]), bounds[1]))
    return math.exp(best) if kind == "log" else best


def _chosen(name: str, choices: Sequence, better: list[dict], others: list[dict], rng: np.random.Generator) -> Any:
    shares = []
    for side in (better, others):
        count = np.array([1.0 + sum(name in p and p[name] == c for p in side) for c in choices])
        shares.append(count / count.sum())
    drawn = rng.choice(len(choices), DRAWS, p=shares[0])
    return choices[int(drawn[np.argmax(shares[0][drawn] / shares[1][drawn])])]


def propose(trials: list[Mapping[str, Any]], space: Mapping[str, tuple], number: int, seed: int = SEED) -> dict[str, Any]:
    """Parameters of trial ``number`` from the finished ones (state, value, params as text, steps).

    Pruned trials rank below all complete ones, by how far they came and how well.
    """
    rng = np.random.default_rng((seed, number))
    done = [t for t in trials if t["number"] < number and (t["state"] == "COMPLETE" and t["value"] is not None or t["state"] == "PRUNED" and t["steps"])]
    done.sort(key=lambda t: (t["state"] != "COMPLETE", -t["value"] if t["state"] == "COMPLETE" else -len(t["steps"]), -(t["steps"] or [0])[-1], t["number"]))
    read = [{n: _read(t["params"][n], kind, b[0] if b else ()) for n, (kind, *b) in space.items() if n in t["params"]} for t in done]
    cut = min(math.ceil(BETTER_SHARE * len(read)), MOST_BETTER) if len(read) >= STARTUP else 0
    better, others = read[:cut], read[cut:] if cut else []
    out: dict[str, Any] = {}
    for name, (kind, *bounds) in space.items():
        needs = _CONDITIONAL.get(name)
        if needs is None or needs[0] not in space or out.get(needs[0]) == needs[1]:
            out[name] = _chosen(name, bounds[0], better, others, rng) if kind == "choice" else _numeric(name, kind, bounds, better, others, rng)
    return out


def run_study(
    spark: SparkSession,
    objective: Callable[[dict, Callable[[int, float], None]], tuple[float, dict]],
    space: Mapping[str, tuple],
    n_trials: int,
    path: str,
    seed: int = SEED,
    rule: Rule | None = None,
    load_if_exists: bool = True,
) -> DataFrame:
    """The trials table at ``path`` after ``n_trials`` more trials of the largest objective.

    ``objective(params, report)`` gives the value and further metrics; ``report(step,
    value)`` ends the trial where ``rule`` stops it.  A study that is there is gone on
    with, or is an error without ``load_if_exists``.  Each trial is appended when it is done, so an
    interrupted search goes on where it stopped.  Refused parameters make a FAIL.
    """
    there = path_exists(spark, path)
    if there and not load_if_exists:
        raise FileExistsError(f"there is a study at {path}")
    known = []
    if there:
        last = spark.read.schema(STUDY_SCHEMA).parquet(path).orderBy(F.desc("number")).limit(MAX_TRIALS)
        known = [r.asDict() for r in last.collect()][::-1]
    number = known[-1]["number"] + 1 if known else 0
    for number in range(number, number + n_trials):
        params = propose(known, space, number, seed)
        earlier = [t["steps"] for t in known if t["steps"]]
        steps: list[float] = []

        def report(step: int, value: float) -> None:
            if step != len(steps):
                raise ValueError(f"step {step} after {len(steps)}")
            steps.append(float(value))
            if rule is not None and rule(step, float(value), earlier):
                raise Pruned

        value, metrics, state = None, {}, "COMPLETE"
        try:
            value, metrics = objective(params, report)
            value, metrics = float(value), {n: None if m is None else float(m) for n, m in metrics.items()}
        except Pruned:
            state = "PRUNED"
        except _REFUSALS as refusal:
            warnings.warn(f"trial {number} failed: {refusal}", stacklevel=2)
            state = "FAIL"
        text = {n: None if v is None else str(v) for n, v in params.items()}
        row = {"number": number, "state": state, "value": value, "params": text, "steps": steps, "metrics": metrics}
        spark.createDataFrame([tuple(row.values())], STUDY_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        known.append(row)
    return spark.read.schema(STUDY_SCHEMA).parquet(path)


def search_family(
    family: str,
    df: DataFrame,
    roles: ColumnRoles,
    n_trials: int,
    path: str,
    k: int = 3,
    shares: Sequence[float] = (1 / 9, 1 / 3, 1.0),
    rule: Rule | None = None,
    seed: int = SEED,
    space: Mapping[str, tuple] | None = None,
    load_if_exists: bool = True,
) -> DataFrame:
    """A study of a model family for the largest mean F1 over ``k`` folds, on growing ``shares`` of the rows.

    Rows come in by a digest of ``row_id``, so each share holds the one before.  Without
    a ``rule`` it is that of halving, with the factor between the shares.  The folds of a
    share are made once, by the first trial that comes to it.
    """
    rule = rule or halving_rule(max(2, round(shares[-1] / shares[-2])) if len(shares) > 1 else 2)
    marked = materialize(df.withColumn("_u", hash_uniform(F.col(roles.row_id), seed, "share")), "shares")
    made: dict[int, DataFrame] = {}

    def folds(step: int) -> DataFrame:
        if step not in made:
            share = shares[step]
            part = marked.filter(F.col("_u") < share).drop("_u") if share < 1 else marked.drop("_u")
            made[step] = materialize(stratified_folds(part, roles, k), "folds")
        return made[step]

    def objective(params: dict, report: Callable[[int, float], None]) -> tuple[float, dict]:
        for step in range(len(shares)):
            s = cv_summary(cross_validate(family, params, folds(step), roles, fold_column="fold"), CV_METRICS).first()
            value = s["mean_f1"] or 0.0
            if step + 1 < len(shares):
                report(step, value)
        return value, {m: s[f"mean_{m}"] for m in CV_METRICS} | {"f1_std": s["f1_std"]}

    return run_study(df.sparkSession, objective, space or SEARCH_SPACES[family], n_trials, path, seed, rule, load_if_exists)
