"""Validation, profiles, splits, folds, transforms, imputation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.functions import scalar
from panelwise.operators import columns as cols
from panelwise.operators import profile_states, split, stages, validate
from panelwise.operators.impute import ChainedImpute
from panelwise.plans.preprocess import Preparation, preprocess
from panelwise.session import session_folder
from panelwise.sources.panel import check_panel, nan_to_null
from workload.registry import query, r6
from workload.views import LINE_FEATURES, LINES_SQL, PANEL_SQL, ROLES, lines, panel, table

PANEL_COLUMNS = (
    "row_id", "entity", "hour", "label", "reading", "level", "hour_of_day", "day_no", "code", "kind", "p",
)
_ALL = ", ".join(PANEL_COLUMNS)


@query("load_panel", f"WITH {PANEL_SQL} SELECT {_ALL} FROM panel")
def _load(spark, sf_dir) -> DataFrame:
    return check_panel(panel(spark, sf_dir), ROLES)


@query(
    "drop_columns",
    f"WITH {PANEL_SQL} SELECT row_id, entity, hour, label, reading, level, kind FROM panel",
)
def _drop(spark, sf_dir) -> DataFrame:
    return cols.drop_columns(panel(spark, sf_dir), ["hour_of_day", "day_no", "code", "p"])


@query(
    "drop_sparse_columns",
    f"""WITH {PANEL_SQL} SELECT row_id, entity, hour, label, hour_of_day, day_no, code, kind, p FROM panel""",
)
def _drop_by_share(spark, sf_dir) -> DataFrame:
    """Both measured columns have gaps, in more than a thousandth of the rows."""
    return cols.drop_sparse_columns(panel(spark, sf_dir), 0.001, keep=["row_id"])


@query(
    "drop_existing_columns",
    f"WITH {PANEL_SQL} SELECT row_id, entity, hour, label, level, hour_of_day, day_no, kind, p FROM panel",
)
def _drop_sparse(spark, sf_dir) -> DataFrame:
    return cols.drop_existing_columns(panel(spark, sf_dir), ["reading", "code", "not_there"])


@query(
    "drop_incomplete_rows",
    f"WITH {PANEL_SQL} SELECT {_ALL} FROM panel WHERE reading IS NOT NULL AND level IS NOT NULL",
)
def _dropna(spark, sf_dir) -> DataFrame:
    return cols.drop_incomplete_rows(panel(spark, sf_dir))


@query(
    "validate_panel",
    f"""WITH {PANEL_SQL}
SELECT 'negative_time' AS rule, count(*) FILTER (hour < 0) AS violations FROM panel
UNION ALL SELECT 'label_not_binary', count(*) FILTER (label IS NULL OR label NOT IN (0, 1)) FROM panel
UNION ALL SELECT 'duplicate_time_points', count(*) FROM
  (SELECT 1 FROM panel GROUP BY entity, hour HAVING count(*) > 1)""",
)
def _validate(spark, sf_dir) -> DataFrame:
    return validate.validate_panel(panel(spark, sf_dir), ROLES)


@query(
    "duplicate_keys",
    f"WITH {PANEL_SQL} SELECT entity, hour, count(*) AS n FROM panel GROUP BY 1, 2 HAVING count(*) > 1",
)
def _duplicates(spark, sf_dir) -> DataFrame:
    return validate.duplicate_keys(panel(spark, sf_dir), ROLES)


_MISSING = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing,
       round((count(*) - count({c})) / CAST(count(*) AS DOUBLE) * 100, 6) AS pct_missing FROM panel"""
    for c in PANEL_COLUMNS
)


@query("missing_profile", f"WITH {PANEL_SQL} {_MISSING}")
def _missing(spark, sf_dir) -> DataFrame:
    return r6(validate.missing_profile(panel(spark, sf_dir)))


@query(
    "missing_mask",
    f"""WITH {PANEL_SQL}
SELECT row_id, CAST(reading IS NULL AS INTEGER) AS reading, CAST(level IS NULL AS INTEGER) AS level FROM panel""",
)
def _mask(spark, sf_dir) -> DataFrame:
    return validate.missing_mask(panel(spark, sf_dir), "row_id", ["reading", "level"])


_PROFILE = " UNION ALL ".join(
    f"SELECT 'missing' AS section, '{c}' AS key, CAST(count(*) - count({c}) AS DOUBLE) AS value FROM panel "
    f"UNION ALL SELECT 'missing_pct', '{c}', round((count(*) - count({c})) / CAST(count(*) AS DOUBLE) * 100, 6) FROM panel"
    for c in ("reading", "level")
)


@query(
    "profile_table",
    f"""WITH {PANEL_SQL} {_PROFILE}
UNION ALL SELECT 'shape', 'rows', CAST(count(*) AS DOUBLE) FROM panel
UNION ALL SELECT 'shape', 'columns', CAST({len(PANEL_COLUMNS)} AS DOUBLE)
UNION ALL SELECT 'class', CAST(label AS VARCHAR), CAST(count(*) AS DOUBLE) FROM panel GROUP BY label""",
)
def _profile(spark, sf_dir) -> DataFrame:
    return r6(validate.profile_table(panel(spark, sf_dir), "label"))


@query(
    "entity_stats",
    f"""WITH {PANEL_SQL}
SELECT entity, max(label) AS label, count(hour) AS n_times, count(*) AS n_rows FROM panel GROUP BY entity""",
)
def _stats(spark, sf_dir) -> DataFrame:
    return split.entity_stats(panel(spark, sf_dir), ROLES)


def assign_sql(stratum: str) -> str:
    return f"""{PANEL_SQL},
es AS (SELECT entity, max(label) AS label, count(*) AS n_rows FROM panel GROUP BY entity),
rk AS (SELECT *, row_number() OVER (PARTITION BY {stratum} ORDER BY md5(entity || ':42'), entity) - 1 AS r,
              count(*) OVER (PARTITION BY {stratum}) AS n FROM es),
assign AS (SELECT entity, label, n_rows,
  CASE WHEN r < floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
       WHEN r < floor(n * CAST(0.7 AS DOUBLE)) + floor(n * CAST(0.15 AS DOUBLE)) THEN 'val'
       ELSE 'test' END AS split FROM rk)"""


@query("stratified_entity_split", f"WITH {assign_sql('label')} SELECT * FROM assign")
def _strat(spark, sf_dir) -> DataFrame:
    return split.split_entities(panel(spark, sf_dir), ROLES)


@query("random_entity_split", f"WITH {assign_sql('1')} SELECT * FROM assign")
def _random(spark, sf_dir) -> DataFrame:
    return split.split_entities(panel(spark, sf_dir), ROLES, stratify=False)


@query(
    "split_rows",
    f"WITH {assign_sql('label')} SELECT p.row_id, p.entity, a.split FROM panel p JOIN assign a USING (entity)",
)
def _split_rows(spark, sf_dir) -> DataFrame:
    df = panel(spark, sf_dir)
    tagged = split.split_rows(df, split.split_entities(df, ROLES), ROLES)
    return tagged.select("row_id", "entity", "split")


@query(
    "split_summary",
    f"""WITH {assign_sql('label')}
SELECT a.split, count(*) AS n_rows, count(DISTINCT p.entity) AS n_entities
FROM panel p JOIN assign a USING (entity) GROUP BY a.split""",
)
def _summary(spark, sf_dir) -> DataFrame:
    return split.split_summary(split.split_entities(panel(spark, sf_dir), ROLES))


@query(
    "split_positive_rate",
    f"WITH {assign_sql('label')} SELECT split, round(avg(label), 6) AS positive_rate FROM assign GROUP BY split",
)
def _rate(spark, sf_dir) -> DataFrame:
    return r6(split.split_positive_rate(split.split_entities(panel(spark, sf_dir), ROLES)))


_HALVES = """CASE WHEN hour < 360 THEN 'early' ELSE 'late' END"""


@query(
    "split_overlap",
    f"""WITH {PANEL_SQL}, t AS (SELECT entity, {_HALVES} AS split FROM panel)
SELECT entity, 'early' AS first_split, 'late' AS last_split FROM
 (SELECT entity FROM t WHERE split = 'early' INTERSECT SELECT entity FROM t WHERE split = 'late')""",
)
def _overlap(spark, sf_dir) -> DataFrame:
    # A split by time shares entities, so there is something to find.
    halves = F.when(F.col("hour") < 360, "early").otherwise("late")
    return split.split_overlap(panel(spark, sf_dir).withColumn("split", halves), ROLES)


@query(
    "stratified_folds",
    f"""WITH {PANEL_SQL},
c AS (SELECT label, count(*) AS n, min(row_id) AS f FROM panel GROUP BY label),
o AS (SELECT label, n, coalesce(sum(n) OVER (ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM c),
folds AS (SELECT label, i, (SELECT count(*) FROM range(CAST(o AS BIGINT), CAST(o + n AS BIGINT)) t(v) WHERE v % 3 <= i) AS upto
          FROM o, range(0, 2) r(i)),
rk AS (SELECT row_id, label, row_number() OVER (PARTITION BY label ORDER BY row_id) - 1 AS r FROM panel)
SELECT row_id, label, CAST((SELECT count(*) FROM folds f WHERE f.label = rk.label AND rk.r >= f.upto) AS INTEGER) AS fold
FROM rk""",
)
def _folds(spark, sf_dir) -> DataFrame:
    return split.stratified_folds(
        panel(spark, sf_dir).select("row_id", "label"), ROLES, 3
    ).select("row_id", "label", "fold")


@query(
    "sample_entities",
    f"""WITH {PANEL_SQL}
SELECT entity FROM (SELECT DISTINCT entity FROM panel WHERE label = 1) ORDER BY md5(entity || ':42'), entity LIMIT 5""",
)
def _sample(spark, sf_dir) -> DataFrame:
    return split.sample_entities(panel(spark, sf_dir), ROLES, 5)


@query(
    "log_transform",
    f"""WITH {PANEL_SQL}
SELECT row_id, round(CASE WHEN reading IS NOT NULL THEN ln(greatest(reading, CAST(0.00001 AS DOUBLE)) + 1) END, 6) AS reading FROM panel""",
)
def _log(spark, sf_dir) -> DataFrame:
    out = stages.ClippedLog(["reading"]).transform(panel(spark, sf_dir))
    return r6(out.select("row_id", "reading"))


KINDS = ("click", "error", "purchase", "signup", "view")
_ONE_HOT = ", ".join(f"CAST(kind = '{k}' AS INTEGER) AS kind_{k}" for k in KINDS)


@query("one_hot_encode", f"WITH {PANEL_SQL} SELECT row_id, {_ONE_HOT} FROM panel")
def _one_hot(spark, sf_dir) -> DataFrame:
    df = panel(spark, sf_dir).select("row_id", "kind")
    return stages.OneHot(["kind"]).fit(df).transform(df)


@query(
    "sanitize_names",
    r"""SELECT source || '/' || lang AS raw,
  regexp_replace(source || '/' || lang || ' <' || quality || '>', '[<>:"/\\|?*]', '_', 'g') AS clean,
  lower(replace('Model ' || source, ' ', '_')) AS slug, count(*) AS n
FROM (SELECT d.*, coalesce(CAST(l.quality AS VARCHAR), 'none') AS quality FROM documents d LEFT JOIN labels l USING (doc_id))
GROUP BY 1, 2, 3""",
)
def _sanitize(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    joined = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    raw = F.concat("source", F.lit("/"), "lang")
    name = F.concat(raw, F.lit(" <"), F.coalesce(F.col("quality").cast("string"), F.lit("none")), F.lit(">"))
    return joined.groupBy(
        raw.alias("raw"),
        scalar.sanitize_name(name).alias("clean"),
        scalar.slug(F.concat(F.lit("Model "), "source")).alias("slug"),
    ).agg(F.count(F.lit(1)).alias("n"))


_STD = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg({c}), 7) AS mean, round(stddev_pop({c}), 7) AS std FROM lines"
    for c in LINE_FEATURES
)
_ROBUST = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, round(quantile_cont({c}, 0.25), 6) AS q25,
        round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q75 FROM lines"""
    for c in LINE_FEATURES
)


@query("standard_stats", f"WITH {LINES_SQL} {_STD}")
def _standard_stats(spark, sf_dir) -> DataFrame:
    stats = stages.standard_stats(lines(spark, sf_dir), LINE_FEATURES)
    return stats.withColumns({c: F.round(c, 7) for c in ("mean", "std")})


@query("robust_stats", f"WITH {LINES_SQL} {_ROBUST}")
def _robust_stats(spark, sf_dir) -> DataFrame:
    return r6(stages.robust_stats(lines(spark, sf_dir), LINE_FEATURES))


@query(
    "standard_scale",
    f"""WITH {PANEL_SQL}, s AS (SELECT avg(reading) AS m1, stddev_pop(reading) AS s1, avg(level) AS m2, stddev_pop(level) AS s2 FROM panel)
SELECT row_id, round((reading - m1) / s1, 6) AS reading, round((level - m2) / s2, 6) AS level FROM panel, s""",
)
def _standard(spark, sf_dir) -> DataFrame:
    df = panel(spark, sf_dir).select("row_id", "reading", "level")
    return r6(stages.StandardScale(["reading", "level"]).fit(df).transform(df))


@query(
    "robust_scale",
    f"""WITH {PANEL_SQL}, s AS (SELECT quantile_cont(reading, 0.5) AS m1, quantile_cont(reading, 0.75) - quantile_cont(reading, 0.25) AS s1,
  quantile_cont(level, 0.5) AS m2, quantile_cont(level, 0.75) - quantile_cont(level, 0.25) AS s2 FROM panel)
SELECT row_id, round((reading - m1) / s1, 6) AS reading, round((level - m2) / s2, 6) AS level FROM panel, s""",
)
def _robust(spark, sf_dir) -> DataFrame:
    df = panel(spark, sf_dir).select("row_id", "reading", "level")
    return r6(stages.RobustScale(["reading", "level"]).fit(df).transform(df))


_NAN = "CASE WHEN row_id % 7 = 0 THEN NULL ELSE {} END"


def _with_nan(spark, sf_dir) -> DataFrame:
    """Two features of which every seventh row is NaN, which counts as missing."""
    df = panel(spark, sf_dir)
    gap = F.col("row_id") % 7 == 0
    return df.select("row_id", *[F.when(gap, F.lit(float("nan"))).otherwise(F.col(c)).alias(c) for c in ("p", "level")])


@query(
    "standard_scale_nan",
    f"""WITH {PANEL_SQL}, g AS (SELECT row_id, {_NAN.format("p")} AS p, {_NAN.format("level")} AS level FROM panel),
s AS (SELECT avg(p) AS m1, stddev_pop(p) AS s1, avg(level) AS m2, stddev_pop(level) AS s2 FROM g)
SELECT row_id, round((p - m1) / s1, 6) AS p, round((level - m2) / s2, 6) AS level FROM g, s""",
)
def _standard_nan(spark, sf_dir) -> DataFrame:
    df = _with_nan(spark, sf_dir)
    return r6(nan_to_null(stages.StandardScale(["p", "level"]).fit(df).transform(df)))


@query(
    "robust_scale_nan",
    f"""WITH {PANEL_SQL}, g AS (SELECT row_id, {_NAN.format("p")} AS p, {_NAN.format("level")} AS level FROM panel),
s AS (SELECT quantile_cont(p, 0.5) AS m1, quantile_cont(p, 0.75) - quantile_cont(p, 0.25) AS s1,
  quantile_cont(level, 0.5) AS m2, quantile_cont(level, 0.75) - quantile_cont(level, 0.25) AS s2 FROM g)
SELECT row_id, round((p - m1) / s1, 6) AS p, round((level - m2) / s2, 6) AS level FROM g, s""",
)
def _robust_nan(spark, sf_dir) -> DataFrame:
    df = _with_nan(spark, sf_dir)
    return r6(nan_to_null(stages.RobustScale(["p", "level"]).fit(df).transform(df)))


@query(
    "value_counts",
    f"WITH {PANEL_SQL} SELECT kind, count(*) AS n FROM panel WHERE kind IS NOT NULL GROUP BY kind",
)
def _value_counts(spark, sf_dir) -> DataFrame:
    return validate.value_counts(panel(spark, sf_dir), "kind", 50)


@query(
    "mean_impute",
    f"""WITH {PANEL_SQL}, s AS (SELECT avg(reading) AS m1, avg(level) AS m2 FROM panel)
SELECT row_id, round(coalesce(reading, m1), 6) AS reading, round(coalesce(level, m2), 6) AS level FROM panel, s""",
)
def _mean_impute(spark, sf_dir) -> DataFrame:
    df = panel(spark, sf_dir).select("row_id", "reading", "level")
    return r6(stages.MeanImpute(["reading", "level"]).fit(df).transform(df))


# The evidence iteration for one predictor, as a recursive query.
_RIDGE_SQL = """s AS (SELECT CAST(regr_count(net, price) AS DOUBLE) AS n, regr_sxx(net, price) AS xx, regr_sxy(net, price) AS xy,
  regr_syy(net, price) AS yy, regr_avgx(net, price) AS mx, regr_avgy(net, price) AS my FROM g),
it(i, coef, weight, noise, done) AS (
  SELECT 0, CAST(NULL AS DOUBLE), CAST(1 AS DOUBLE), 1 / (yy / n + 2.220446049250313e-16), false FROM s
  UNION ALL
  SELECT i + 1, c, (wd + 2e-6) / (c * c + 2e-6), (n - wd + 2e-6) / (err + 2e-6),
         coef IS NOT NULL AND abs(coef - c) < 1e-3
  FROM (SELECT it.*, n, xy / (xx + weight / noise) AS c, noise * xx / (weight + noise * xx) AS wd,
               greatest(yy - 2 * (xy / (xx + weight / noise)) * xy + (xy / (xx + weight / noise)) ** 2 * xx, 0) AS err
        FROM it, s WHERE NOT done AND i < 300)),
fit AS (SELECT xy / (xx + weight / noise) AS b, my, mx FROM it, s ORDER BY i DESC LIMIT 1)"""


@query(
    "regression_impute",
    f"""WITH RECURSIVE {LINES_SQL}, g AS (SELECT quantity, price, CASE WHEN label = 0 THEN net END AS net FROM lines),
{_RIDGE_SQL}
SELECT CAST(round(quantity) AS INTEGER) AS quantity, count(*) AS n,
       round(sum(coalesce(net, my + b * (price - mx))) / count(*), 4) AS net FROM g, fit GROUP BY 1""",
)
def _regression_impute(spark, sf_dir) -> DataFrame:
    """One incomplete column on one predictor, one round."""
    df = lines(spark, sf_dir).select(
        "quantity", "price", F.when(F.col("label") == 0, F.col("net")).alias("net")
    )
    done = ChainedImpute(["price", "net"], maxRounds=1).fit(df).transform(df)
    return done.groupBy(F.round("quantity").cast("int").alias("quantity")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("net") / F.count(F.lit(1)), 4).alias("net")
    )


@query("iterative_impute")
def _iterative(spark, sf_dir) -> DataFrame:
    df = panel(spark, sf_dir)
    names = ["reading", "level", "hour_of_day", "day_no", "p"]
    return ChainedImpute(names).fit(df).transform(df).select("row_id", *names)


PREPARE = Preparation(
    drop_first=("day_no",),
    impute=("reading", "level"),
    drop_after=("code", "not_there"),
    one_hot=("kind",),
    log=("reading",),
    scale=("reading", "level", "hour_of_day"),
    method="mean",
)


@query(
    "preprocess_panel",
    f"""WITH {PANEL_SQL}, m AS (SELECT avg(reading) AS m1, avg(level) AS m2 FROM panel),
f AS (SELECT row_id, entity, hour, label, kind, p, hour_of_day, coalesce(level, m2) AS level,
             ln(greatest(coalesce(reading, m1), CAST(0.00001 AS DOUBLE)) + 1) AS reading FROM panel, m),
s AS (SELECT quantile_cont(reading, 0.5) AS c1, quantile_cont(reading, 0.75) - quantile_cont(reading, 0.25) AS w1,
             quantile_cont(level, 0.5) AS c2, quantile_cont(level, 0.75) - quantile_cont(level, 0.25) AS w2,
             quantile_cont(hour_of_day, 0.5) AS c3, quantile_cont(hour_of_day, 0.75) - quantile_cont(hour_of_day, 0.25) AS w3 FROM f)
SELECT row_id, entity, hour, label, p, round((reading - c1) / w1, 6) AS reading, round((level - c2) / w2, 6) AS level,
       round((hour_of_day - c3) / w3, 6) AS hour_of_day, {_ONE_HOT} FROM f, s""",
)
def _preprocess(spark, sf_dir) -> DataFrame:
    _, prepared = preprocess(panel(spark, sf_dir), PREPARE, ROLES)
    return r6(prepared, "reading", "level", "hour_of_day")


_MERGED = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS n, count(*) - count({c}) AS n_missing, round(avg({c}), 6) AS mean,
        round(stddev_pop({c}), 6) AS std, min({c}) AS low, max({c}) AS high FROM panel"""
    for c in ("reading", "level", "hour_of_day")
)


@query("profile_merged", f"WITH {PANEL_SQL} {_MERGED}")
def _profile_merged(spark, sf_dir) -> DataFrame:
    """A profile of all days, merged from the states of each day, which are added in two steps."""
    df, path = panel(spark, sf_dir), f"{session_folder(spark)}/states-{uuid.uuid4().hex}"
    names = ["reading", "level", "hour_of_day"]
    profile_states.update_states(df.filter("day_no < 10"), names, F.col("day_no"), path)
    profile_states.update_states(df, names, F.col("day_no"), path)
    merged = profile_states.merged_profile(profile_states.read_states(spark, path))
    return r6(merged.select("column_name", "n", "n_missing", "mean", "std", "low", "high"), "mean", "std")
