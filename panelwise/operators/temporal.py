"""Row windows over time, onsets and timelines per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwise.operators.ordering import with_position
from panelwise.operators.split import sample_entities
from panelwise.roles import ColumnRoles
from panelwise.session import broadcast_if_small, materialize


def _centered(frame, feature: str, window: int) -> Column:
    """Mean over the frame, only when all its rows exist and hold a value."""
    return F.when(F.count(feature).over(frame) == window, F.avg(feature).over(frame))


def rolling_centered_mean(
    df: DataFrame,
    roles: ColumnRoles,
    features: Sequence[str],
    window: int = 5,
    suffix: str = "_smooth",
    max_entity_rows: int = 1_000_000,
) -> DataFrame:
    """Centered mean over ``window`` rows per entity in time order.

    While no entity has more than ``max_entity_rows`` rows a window per entity
    does.  Otherwise rows are numbered in global order and cut into blocks; each
    block also gets the few rows next to its borders, so an entity of any size
    is spread over many tasks with the same result.
    """
    before, after = window // 2, (window - 1) // 2
    largest = df.groupBy(roles.entity).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    order = [F.col(roles.time), F.col(roles.row_id)]
    if largest is None or largest <= max_entity_rows:
        frame = Window.partitionBy(roles.entity).orderBy(*order).rowsBetween(-before, after)
        return df.withColumns({f"{c}{suffix}": _centered(frame, c, window) for c in features})
    if max_entity_rows < window:
        raise ValueError("max_entity_rows must be at least the window")
    placed = with_position(df, F.col(roles.entity), *order, name="_pos")
    size = F.lit(max_entity_rows)
    home = F.floor(F.col("_pos") / size)
    reached = F.array_distinct(
        F.array(
            home,
            F.floor((F.col("_pos") + before) / size),
            F.floor((F.col("_pos") - after) / size),
        )
    )
    spread = placed.withColumns({"_home": home, "_block": F.explode(reached)})
    frame = (
        Window.partitionBy("_block", roles.entity).orderBy("_pos").rowsBetween(-before, after)
    )
    smooth = spread.withColumns({f"{c}{suffix}": _centered(frame, c, window) for c in features})
    return smooth.filter(F.col("_block") == F.col("_home")).drop("_pos", "_home", "_block")


def label_onset(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """First time with label 1 per entity, NULL when there is none."""
    return _onsets(df, roles, label_onset=F.col(roles.label) == 1)


def predicted_onset(df: DataFrame, roles: ColumnRoles, threshold: float = 0.5) -> DataFrame:
    """First time with a prediction above the threshold per entity."""
    return _onsets(df, roles, predicted_onset=F.col(roles.prediction) > F.lit(threshold))


def _onsets(df: DataFrame, roles: ColumnRoles, **when: Column) -> DataFrame:
    return df.groupBy(F.col(roles.entity).alias("entity")).agg(
        *[F.min(F.when(hit, F.col(roles.time))).alias(name) for name, hit in when.items()]
    )


def onset_lead(df: DataFrame, roles: ColumnRoles, threshold: float = 0.5) -> DataFrame:
    """Both onsets per entity and how far the prediction came ahead of the label."""
    both = _onsets(
        df,
        roles,
        label_onset=F.col(roles.label) == 1,
        predicted_onset=F.col(roles.prediction) > F.lit(threshold),
    )
    return both.withColumn("lead", F.col("label_onset") - F.col("predicted_onset"))


def _rows_of(df: DataFrame, roles: ColumnRoles, entities: DataFrame) -> DataFrame:
    keys = entities.select(F.col("entity").alias("_entity"))
    mine = df.join(
        broadcast_if_small(keys), F.col(roles.entity).cast("string") == F.col("_entity"), "left_semi"
    )
    # Read several times below; the whole panel is read once.
    return materialize(mine, "chosen")


def temporal_progression(
    df: DataFrame,
    roles: ColumnRoles,
    features: Sequence[str],
    max_entities: int = 5,
    window: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Smoothed features and label onset for a sample of positive entities."""
    used = df.select(roles.entity, roles.time, roles.row_id, roles.label, *features)
    chosen = _rows_of(used, roles, sample_entities(df, roles, max_entities, seed))
    smooth = rolling_centered_mean(chosen, roles, features, window)
    onset = label_onset(chosen, roles).withColumnRenamed("entity", "_e")
    joined = smooth.join(broadcast_if_small(onset), F.col(roles.entity) == F.col("_e"))
    return joined.select(
        roles.entity, roles.time, roles.row_id, *[f"{c}_smooth" for c in features], "label_onset"
    )


def prediction_timeline(
    df: DataFrame,
    roles: ColumnRoles,
    max_entities: int = 5,
    threshold: float = 0.5,
    seed: int = 42,
) -> DataFrame:
    """Label against prediction over time, with both onsets, for sampled entities.

    Only rows with a prediction take part.
    """
    used = df.select(roles.entity, roles.time, roles.row_id, roles.label, roles.prediction)
    scored = used.filter(F.col(roles.prediction).isNotNull())
    chosen = _rows_of(scored, roles, sample_entities(scored, roles, max_entities, seed))
    onsets = onset_lead(chosen, roles, threshold).withColumnRenamed("entity", "_e")
    joined = chosen.join(broadcast_if_small(onsets), F.col(roles.entity) == F.col("_e"))
    return joined.select(
        roles.entity,
        roles.time,
        roles.row_id,
        F.col(roles.label).alias("actual"),
        F.col(roles.prediction).alias("predicted"),
        "label_onset",
        "predicted_onset",
    )


def attach_predictions(rows: DataFrame, predictions: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Left join of predictions on the row key; rows without one get NULL."""
    keep = [c for c in (roles.prediction, roles.score) if c in predictions.columns]
    return rows.drop(*keep).join(predictions.select(roles.row_id, *keep), roles.row_id, "left")
