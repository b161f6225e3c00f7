from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwise.operators import profile_states as states
from panelwise.operators import split, temporal
from panelwise.roles import ColumnRoles
from panelwise.sources import bucketed

ROLES = ColumnRoles().with_features("a")


def panel(spark, n=3000, entities=40):
    rng = np.random.default_rng(4)
    rows = [
        (i, f"e{rng.integers(entities)}", int(rng.integers(200)), int(rng.random() < 0.05), float(v) if rng.random() > 0.1 else None, 1e6 + float(v), i % 5)
        for i, v in enumerate(rng.normal(size=n) * 3)
    ]
    return spark.createDataFrame(rows, "row_id long, entity string, hour int, label int, a double, b double, day int").repartition(4)


def test_merged_profile_equals_a_full_pass(spark, tmp_path):
    df, path = panel(spark), str(tmp_path / "states")
    day = F.col("day")
    assert states.update_states(df.filter("day < 2"), ["a", "b"], day, path) == ["0", "1"]
    read = []
    assert states.update_states(df.filter("day < 4"), ["a", "b"], day, path) == ["2", "3"]
    assert states.update_states(df, ["a", "b"], day, path) == ["4"]
    assert states.update_states(df, ["a", "b"], day, path) == read
    got = {r["column_name"]: r for r in states.merged_profile(states.read_states(spark, path), (0.1, 0.5, 0.9)).collect()}
    for c in ("a", "b"):
        want = df.agg(F.count(c), F.count_if(F.col(c).isNull()), F.avg(c), F.stddev_pop(c), F.min(c), F.max(c), F.count_distinct(c)).first()
        r = got[c]
        assert (r["n"], r["n_missing"], r["low"], r["high"]) == (want[0], want[1], want[4], want[5])
        assert abs(r["mean"] - want[2]) < 1e-9 * max(1, abs(want[2])) and abs(r["std"] - want[3]) < 1e-7
        assert abs(r["n_different"] - want[6]) < 0.1 * want[6]
        values = np.sort([x[0] for x in df.select(c).filter(F.col(c).isNotNull()).collect()])
        for share, value in zip((0.1, 0.5, 0.9), r["quantiles"]):
            assert abs(np.searchsorted(values, value) / len(values) - share) <= states.RANK_ERROR + 1 / len(values)


def test_a_part_can_be_read_again_and_known_parts_are_not(spark, tmp_path):
    df, path = panel(spark, 400), str(tmp_path / "states")
    states.update_states(df, ["a"], F.col("day"), path)
    changed = df.withColumn("a", F.when(F.col("day") == 1, F.lit(5.0)).otherwise(F.raise_error(F.lit("read again"))))
    assert states.update_states(changed.filter("day = 1"), ["a"], F.col("day"), path, again=["1"]) == ["1"]
    first = {r["part"]: r for r in states.read_states(spark, path).collect()}
    assert first["1"]["mean"] == 5.0 and len(first) == 5
    assert states.update_states(df.withColumn("a", F.raise_error(F.lit("read again")).cast("double")), ["a"], F.col("day"), path) == []


def test_profiles_of_odd_tables(spark, tmp_path):
    empty = panel(spark, 10).limit(0)
    assert states.update_states(empty, ["a"], F.col("day"), str(tmp_path / "e")) == []
    none = spark.createDataFrame([(1, None), (1, float("nan"))], "day int, a double")
    row = states.merged_profile(states.part_states(none, ["a"], F.col("day"))).first()
    assert (row["n"], row["n_missing"], row["mean"], row["std"], row["n_different"], row["quantiles"]) == (0, 2, None, None, 0, None)


@pytest.fixture
def exact_plans(spark):
    """Plans as they are before any stage has run."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_plans_over_bucketed_tables_have_no_exchange(spark, exact_plans):
    df = panel(spark)
    entities = split.split_entities(df, ROLES).select("entity", "split")
    rows = bucketed.read_bucketed(spark, bucketed.write_bucketed(df, ROLES, buckets=4))
    held = bucketed.read_bucketed(spark, bucketed.write_bucketed(entities, ROLES, buckets=4))
    smooth = temporal.rolling_centered_mean(rows, ROLES, ["a"])
    onset, stats = temporal.label_onset(rows, ROLES), split.entity_stats(rows, ROLES)
    tagged = bucketed.assign_bucketed(rows, held, ROLES)
    for plan in (smooth, onset, stats, tagged):
        assert not bucketed.has_exchange(plan)
    assert bucketed.has_exchange(temporal.label_onset(df, ROLES))
    same = temporal.rolling_centered_mean(df, ROLES, ["a"])
    assert sorted(map(tuple, smooth.select("row_id", "a_smooth").collect())) == sorted(map(tuple, same.select("row_id", "a_smooth").collect()))
    assert sorted(map(tuple, onset.collect())) == sorted(map(tuple, temporal.label_onset(df, ROLES).collect()))
    want = split.split_rows(df, entities, ROLES).select("row_id", "split")
    assert sorted(map(tuple, tagged.select("row_id", "split").collect())) == sorted(map(tuple, want.collect()))
    assert bucketed.bucket_count(5_000_000) == 3 and bucketed.bucket_count(0) == 1
