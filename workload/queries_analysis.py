"""Temporal analyses, onsets, correlations, trends."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.operators import relations, temporal, wide_relations
from panelwise.operators.validate import card_stats
from panelwise.sources import bucketed
from workload.queries_prepare import assign_sql
from workload.registry import query, r6
from workload.views import LINE_FEATURES, LINES_SQL, PANEL_SQL, ROLES, lines, panel, scored


def _smooth_sql(columns, source: str) -> str:
    frame = "(PARTITION BY entity ORDER BY hour, row_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)"
    parts = ", ".join(
        f"round(CASE WHEN count({c}) OVER {frame} = 5 THEN avg({c}) OVER {frame} END, 6) AS {c}_smooth"
        for c in columns
    )
    return f"SELECT entity, hour, row_id, {parts} FROM {source}"


@query("rolling_centered_mean", f"WITH {PANEL_SQL} {_smooth_sql(['level', 'p'], 'panel')}")
def _rolling(spark, sf_dir) -> DataFrame:
    df = panel(spark, sf_dir).select("entity", "hour", "row_id", "level", "p")
    out = temporal.rolling_centered_mean(df, ROLES, ["level", "p"])
    return r6(out.select("entity", "hour", "row_id", "level_smooth", "p_smooth"))


@query("rolling_blocks", f"WITH {PANEL_SQL} {_smooth_sql(['level', 'p'], 'panel')}")
def _rolling_blocks(spark, sf_dir) -> DataFrame:
    """The same rows by the route of entities that are too large for one window."""
    df = panel(spark, sf_dir).select("entity", "hour", "row_id", "level", "p")
    out = temporal.rolling_centered_mean(df, ROLES, ["level", "p"], max_entity_rows=50)
    return r6(out.select("entity", "hour", "row_id", "level_smooth", "p_smooth"))


@query(
    "label_onset",
    f"WITH {PANEL_SQL} SELECT entity, min(hour) FILTER (label = 1) AS label_onset FROM panel GROUP BY entity",
)
def _onset(spark, sf_dir) -> DataFrame:
    return temporal.label_onset(panel(spark, sf_dir), ROLES)


@query(
    "predicted_onset",
    f"WITH {PANEL_SQL} SELECT entity, min(hour) FILTER (yhat > 0.5) AS predicted_onset FROM scored GROUP BY entity",
)
def _predicted(spark, sf_dir) -> DataFrame:
    return temporal.predicted_onset(scored(spark, sf_dir), ROLES)


@query(
    "onset_lead",
    f"""WITH {PANEL_SQL}, o AS (SELECT entity, min(hour) FILTER (label = 1) AS label_onset,
  min(hour) FILTER (yhat > 0.5) AS predicted_onset FROM scored GROUP BY entity)
SELECT *, label_onset - predicted_onset AS lead FROM o""",
)
def _lead(spark, sf_dir) -> DataFrame:
    return temporal.onset_lead(scored(spark, sf_dir), ROLES)


_CHOSEN = """chosen AS (SELECT entity FROM (SELECT DISTINCT entity FROM scored WHERE label = 1)
  ORDER BY md5(entity || ':42'), entity LIMIT 5),
mine AS (SELECT s.* FROM scored s JOIN chosen USING (entity)),
o AS (SELECT entity, min(hour) FILTER (label = 1) AS label_onset,
             min(hour) FILTER (yhat > 0.5) AS predicted_onset FROM mine GROUP BY entity)"""


@query(
    "temporal_progression",
    f"""WITH {PANEL_SQL}, {_CHOSEN}
SELECT w.*, o.label_onset FROM ({_smooth_sql(['level', 'p', 'code'], 'mine')}) w JOIN o USING (entity)""",
)
def _progression(spark, sf_dir) -> DataFrame:
    return r6(temporal.temporal_progression(panel(spark, sf_dir), ROLES, ["level", "p", "code"]))


@query(
    "prediction_timeline",
    f"""WITH {PANEL_SQL}, {_CHOSEN}
SELECT entity, hour, row_id, label AS actual, yhat AS predicted, label_onset, predicted_onset
FROM mine JOIN o USING (entity)""",
)
def _timeline(spark, sf_dir) -> DataFrame:
    return temporal.prediction_timeline(scored(spark, sf_dir), ROLES)


@query(
    "attach_predictions",
    f"""WITH {PANEL_SQL}
SELECT row_id, entity, hour, label, CASE WHEN reading IS NOT NULL AND level IS NOT NULL THEN yhat END AS yhat,
       CASE WHEN reading IS NOT NULL AND level IS NOT NULL THEN p END AS p FROM scored""",
)
def _attach(spark, sf_dir) -> DataFrame:
    rows = panel(spark, sf_dir).select("row_id", "entity", "hour", "label")
    complete = scored(spark, sf_dir).na.drop().select("row_id", "yhat", "p")
    return temporal.attach_predictions(rows, complete, ROLES)


_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {i} AS i, round(abs(corr({a}, {b})), 6) AS corr FROM lines"
    for i, (a, b) in enumerate(combinations(LINE_FEATURES, 2))
)


@query("correlation_pairs", f"WITH {LINES_SQL}, c AS ({_PAIRS}) SELECT feature_a, feature_b, corr FROM c")
def _corr(spark, sf_dir) -> DataFrame:
    return r6(relations.correlation_pairs(lines(spark, sf_dir), LINE_FEATURES))


@query("correlation_pairs_wide", f"WITH {LINES_SQL}, c AS ({_PAIRS}) SELECT feature_a, feature_b, corr FROM c")
def _corr_wide(spark, sf_dir) -> DataFrame:
    """The same pairs by the route of wide tables: blocks of columns, several passes."""
    return r6(wide_relations.correlation_pairs_wide(lines(spark, sf_dir), LINE_FEATURES, block=2, task_bytes=500))


@query(
    "top_correlated_pairs",
    f"WITH {LINES_SQL}, c AS ({_PAIRS}) SELECT feature_a, feature_b, corr FROM c ORDER BY c.corr DESC, i LIMIT 5",
)
def _top(spark, sf_dir) -> DataFrame:
    return r6(relations.top_correlated_pairs(lines(spark, sf_dir), LINE_FEATURES))


@query(
    "correlation_prune",
    f"""WITH {LINES_SQL}, c AS ({_PAIRS}), d AS (SELECT DISTINCT feature_b AS f FROM c WHERE c.corr > 0.6)
SELECT feature_a, feature_b, corr FROM c WHERE feature_a NOT IN (SELECT f FROM d) AND feature_b NOT IN (SELECT f FROM d)""",
)
def _prune(spark, sf_dir) -> DataFrame:
    _, left = relations.correlation_prune(lines(spark, sf_dir), LINE_FEATURES)
    return r6(left)


@query(
    "class_trend_lines",
    f"""WITH {LINES_SQL}
SELECT label, 'price' AS feature_a, 'net' AS feature_b, CAST(regr_count(net, price) AS BIGINT) AS n,
  round(regr_slope(net, price), 6) AS slope, round(regr_intercept(net, price), 6) AS intercept,
  round(regr_r2(net, price), 6) AS r2 FROM lines GROUP BY label
UNION ALL
SELECT label, 'quantity', 'saving', CAST(regr_count(saving, quantity) AS BIGINT), round(regr_slope(saving, quantity), 6),
  round(regr_intercept(saving, quantity), 6), round(regr_r2(saving, quantity), 6) FROM lines GROUP BY label""",
)
def _trend(spark, sf_dir) -> DataFrame:
    pairs = [("price", "net"), ("quantity", "saving")]
    return r6(relations.class_trend_lines(lines(spark, sf_dir), pairs, "label"))


_LINES_OF = " UNION ALL ".join(
    f"""SELECT label, '{a}' AS feature_a, '{b}' AS feature_b, CAST(regr_count({b}, {a}) AS BIGINT) AS n,
  round(regr_slope({b}, {a}), 5) AS slope, round(regr_intercept({b}, {a}), 5) AS intercept,
  round(regr_r2({b}, {a}), 5) AS r2 FROM lines GROUP BY label"""
    for a, b in combinations(LINE_FEATURES, 2)
)


@query(
    "feature_interactions",
    f"""WITH {LINES_SQL}, c AS ({_PAIRS}), top AS (SELECT feature_a, feature_b, round(corr, 5) AS corr FROM c ORDER BY c.corr DESC, i LIMIT 5),
l AS ({_LINES_OF}) SELECT l.*, top.corr FROM l JOIN top USING (feature_a, feature_b)""",
)
def _interactions(spark, sf_dir) -> DataFrame:
    out = relations.feature_interactions(lines(spark, sf_dir), LINE_FEATURES, "label")
    return out.withColumns({c: F.round(c, 5) for c in ("slope", "intercept", "r2", "corr")})


_CARD_METRICS = """m AS (SELECT CAST(count(*) FILTER (label = 1 AND yhat = 1) AS DOUBLE) AS tp,
  CAST(count(*) FILTER (label = 0 AND yhat = 1) AS DOUBLE) AS fp,
  CAST(count(*) FILTER (label = 1 AND yhat = 0) AS DOUBLE) AS fn,
  CAST(count(*) FILTER (label = 0 AND yhat = 0) AS DOUBLE) AS tn
  FROM scored JOIN (SELECT entity, split FROM assign) USING (entity) WHERE split = 'test')"""


@query(
    "card_stats",
    f"""WITH {assign_sql('label')}, t AS (SELECT p.*, a.split FROM scored p JOIN assign a USING (entity)), {_CARD_METRICS}
SELECT 'samples' AS section, split AS key, CAST(count(*) AS DOUBLE) AS value FROM t GROUP BY split
UNION ALL SELECT 'class_share', CAST(label AS VARCHAR), round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6)
  FROM t WHERE split = 'train' GROUP BY label
UNION ALL SELECT 'features', 'columns', CAST(12 AS DOUBLE)
UNION ALL SELECT 'metric', 'f1', round(2 * tp / (2 * tp + fp + fn), 4) FROM m
UNION ALL SELECT 'metric', 'precision', round(coalesce(tp / nullif(tp + fp, 0), 0), 4) FROM m
UNION ALL SELECT 'metric', 'recall', round(coalesce(tp / nullif(tp + fn, 0), 0), 4) FROM m
UNION ALL SELECT 'metric', 'specificity', round(tn / (tn + fp), 4) FROM m""",
)
def _card(spark, sf_dir) -> DataFrame:
    from panelwise.operators import counts, split
    from panelwise.session import materialize

    df = scored(spark, sf_dir)
    tagged = materialize(split.split_rows(df, split.split_entities(df, ROLES), ROLES), "tagged")
    found = counts.classification_metrics(tagged.filter(F.col("split") == "test"), ROLES).first()
    wanted = {m: found[m] for m in ("f1", "precision", "recall", "specificity")}
    return r6(card_stats(tagged, ROLES, wanted))


@query("rolling_bucketed", f"WITH {PANEL_SQL} {_smooth_sql(['level', 'p'], 'panel')}")
def _rolling_bucketed(spark, sf_dir) -> DataFrame:
    """The same rows from a table bucketed by entity, whose plan has no exchange."""
    df = panel(spark, sf_dir).select("entity", "hour", "row_id", "level", "p")
    rows = bucketed.read_bucketed(spark, bucketed.write_bucketed(df, ROLES))
    out = temporal.rolling_centered_mean(rows, ROLES, ["level", "p"])
    return r6(out.select("entity", "hour", "row_id", "level_smooth", "p_smooth"))


@query(
    "onset_bucketed",
    f"WITH {PANEL_SQL} SELECT entity, min(hour) FILTER (label = 1) AS label_onset FROM panel GROUP BY entity",
)
def _onset_bucketed(spark, sf_dir) -> DataFrame:
    df = panel(spark, sf_dir).select("entity", "hour", "row_id", "label")
    return temporal.label_onset(bucketed.read_bucketed(spark, bucketed.write_bucketed(df, ROLES)), ROLES)
