"""Trial logs of a parameter search: reading, writing, analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Columns of a trial log file.
LOG_SCHEMA = (
    "number int, value double, f1_score double, accuracy double, roc_auc double, precision double, "
    "recall double, f1_std double, cv_iteration int, params string"
)


def parse_params(text):
    """Python dict text to map<string,string>; None, True and False become JSON words."""
    json = F.regexp_replace(text, r"\bNone\b", "null")
    json = F.regexp_replace(F.regexp_replace(json, r"\bTrue\b", "true"), r"\bFalse\b", "false")
    return F.from_json(json, "map<string,string>", {"allowSingleQuotes": "true"})


def read_trial_log(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(LOG_SCHEMA).option("header", True).option("escape", '"').csv(path)
    return raw.withColumn("params", parse_params(F.col("params")))


def write_trial_log(trials: DataFrame, path: str, study: str) -> None:
    """Append the completed trials of a study to the trials table."""
    done = trials.filter(F.col("state") == "COMPLETE") if "state" in trials.columns else trials
    done.withColumn("study", F.lit(study)).write.mode("append").partitionBy("study").parquet(path)


def running_best(trials: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Largest value so far by trial number, per study."""
    order = Window.partitionBy(*by).orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    return trials.select(*by, "number", "value", F.max("value").over(order).alias("best"))


def trial_slice(trials: DataFrame) -> DataFrame:
    """One row per trial and parameter: number, param, param_value, value."""
    return trials.select("number", "value", F.explode("params").alias("param", "param_value"))


def state_counts(trials: DataFrame) -> DataFrame:
    return trials.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def param_importance(trials: DataFrame) -> DataFrame:
    """param, kind, importance: how much each parameter goes with the objective.

    Numeric parameters: absolute rank correlation.  Others: share of the
    objective's variance between the values.  A simple stand-in for a
    variance decomposition over a fitted model.
    """
    long = trial_slice(trials).filter(F.col("value").isNotNull())
    number = F.expr("try_cast(param_value AS double)")
    typed = long.withColumn("x", number)
    kinds = Window.partitionBy("param")
    typed = typed.withColumn(
        "numeric", F.min(F.col("x").isNotNull() | F.col("param_value").isNull()).over(kinds)
        & (F.count("x").over(kinds) > 0)
    )
    numeric = typed.filter("numeric AND x IS NOT NULL")

    def mid_rank(column: str):
        order = Window.partitionBy("param").orderBy(column)
        ties = Window.partitionBy("param", column)
        return F.rank().over(order) + (F.count(F.lit(1)).over(ties) - 1) / 2.0

    ranked = numeric.select("param", mid_rank("x").alias("rx"), mid_rank("value").alias("ry"))
    # corr() divides by zero on a constant parameter, so it is put together here.
    spread = F.stddev_pop("rx") * F.stddev_pop("ry")
    by_rank = ranked.groupBy("param").agg(
        F.lit("numeric").alias("kind"),
        F.abs(F.try_divide(F.covar_pop("rx", "ry"), spread)).alias("importance"),
    )
    groups = (
        typed.filter("NOT numeric")
        .groupBy("param", "param_value")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("m"), F.sum(F.col("value") * F.col("value")).alias("ss"))
    )
    n, mean = F.sum("n"), F.sum(F.col("n") * F.col("m")) / F.sum("n")
    between = F.sum(F.col("n") * F.col("m") * F.col("m")) - n * mean * mean
    total = F.sum("ss") - n * mean * mean
    by_group = groups.groupBy("param").agg(
        F.lit("category").alias("kind"), F.when(total > 0, between / total).alias("importance")
    )
    return by_rank.unionByName(by_group)


def pair_grid(trials: DataFrame, a: str, b: str, bins: int = 10) -> DataFrame:
    """Mean objective per cell of two parameters; numeric ones are cut into equal bins."""
    wide = trials.select(
        F.col("params")[a].alias("a"), F.col("params")[b].alias("b"), "value"
    ).filter("value IS NOT NULL")
    number = {side: F.expr(f"try_cast({side} AS double)") for side in ("a", "b")}
    ranges = wide.agg(
        *[f(x).alias(f"{t}_{side}") for side, x in number.items() for t, f in (("lo", F.min), ("hi", F.max))]
    ).first()
    for side, x in number.items():
        low, high = ranges[f"lo_{side}"], ranges[f"hi_{side}"]
        cell = F.lit("0")
        if low is not None and high > low:
            place = F.floor((x - F.lit(low)) / F.lit((high - low) / bins))
            cell = F.least(place, F.lit(bins - 1)).cast("string")
        wide = wide.withColumn(f"cell_{side}", F.when(x.isNotNull(), cell).otherwise(F.col(side)))
    return wide.groupBy("cell_a", "cell_b").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"), F.max("value").alias("best_value")
    )


def parallel_coordinates(trials: DataFrame, names: list[str]) -> DataFrame:
    """One row per trial with the named parameters as columns."""
    return trials.select("number", "value", *[F.col("params")[n].alias(n) for n in names])
