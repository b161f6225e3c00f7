"""The whole evaluation of a scored panel as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwise.operators import counts, curves, relations, temporal, validate
from panelwise.plans.training import feature_importance
from panelwise.roles import ColumnRoles
from panelwise.session import materialize


def evaluation_report(
    scored: DataFrame,
    roles: ColumnRoles,
    groups: Mapping[str, Column] | None = None,
    temporal_features: Sequence[str] = (),
    model: PipelineModel | None = None,
    max_entities: int = 5,
    top_n: int = 5,
) -> dict[str, DataFrame]:
    """Every analysis by name.  The scored rows and the curve counts are written once."""
    df = materialize(scored, "scored")
    report = {
        "metrics": counts.classification_metrics(df, roles),
        "confusion": counts.confusion_matrix(df, roles),
        "confusion_normalized": counts.confusion_matrix_normalized(df, roles),
        "class_distribution": counts.class_distribution(df, roles.label),
    }
    if roles.score in df.columns:
        curve = materialize(curves.cumulative_counts(df, roles, corners=True), "curve")
        report["areas"] = curves.areas_from_cumulative(curve)
        report["roc_curve"] = curves.roc_from_cumulative(curve)
        report["pr_curve"] = curves.pr_from_cumulative(curve)
        report["calibration"] = counts.calibration_curve(df, roles)
    if model is not None:
        report["feature_importance"] = feature_importance(model, roles, df.sparkSession)
    report["missing"] = validate.missing_profile(df)
    if temporal_features:
        report["temporal_progression"] = temporal.temporal_progression(
            df, roles, temporal_features, max_entities
        )
    if groups:
        report["group_errors"] = counts.group_error_analysis(df, roles, groups)
    if len(roles.features) > 1:
        report["interactions"] = relations.feature_interactions(df, roles.features, roles.label, top_n)
    report["timeline"] = temporal.prediction_timeline(df, roles, max_entities)
    return report


# Key columns that are doubles; other doubles are measures and other columns keys.
DOUBLE_KEYS = {"roc_curve": ("threshold",), "pr_curve": ("threshold",)}


def report_table(report: Mapping[str, DataFrame]) -> DataFrame:
    """All tables of a report as (section, item, measure, value).

    ``item`` holds a row's keys, a missing one as NULL, so that the points of a
    curve can be matched to their threshold.
    """
    out = None
    for section, df in report.items():
        doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
        doubles = [c for c in doubles if c not in DOUBLE_KEYS.get(section, ())]
        if not doubles:
            doubles = [df.columns[-1]]
        keys = [c for c in df.columns if c not in doubles]
        item = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in keys]) if keys else F.lit("")
        measures = F.array(
            *[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in doubles]
        )
        long = df.select(F.lit(section).alias("section"), item.alias("item"), F.inline(measures))
        out = long if out is None else out.unionByName(long)
    return out
