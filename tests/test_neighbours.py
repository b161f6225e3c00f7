from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwise.operators import inverted, neighbours, resample


def frame(spark, x, labels=None, parts=3):
    labels = labels if labels is not None else [0] * len(x)
    rows = [(i, int(y), [float(v) for v in r]) for i, (r, y) in enumerate(zip(x, labels))]
    return spark.createDataFrame(rows, "row_id long, label int, vec array<double>").repartition(parts)


def brute(x, k):
    """All pairs, distances at 6 decimals, ties by row number."""
    out = {}
    for i in range(len(x)):
        d = np.round(np.sqrt(((x - x[i]) ** 2).sum(1)), 6)
        order = [j for j in np.lexsort((np.arange(len(x)), d)) if j != i][:k]
        out[i] = [(int(j), float(d[j])) for j in order]
    return out


def found(df, k, **options):
    rows = neighbours.nearest_neighbours(df, k, **options).collect()
    return {r["row_id"]: [(n["id"], n["distance"]) for n in r["neighbours"]] for r in rows}


def test_matches_brute_force_over_many_cells_and_chunks(spark):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(6, 3)) * 10
    x = centers[rng.integers(0, 6, 240)] + rng.normal(size=(240, 3))
    assert found(frame(spark, x), 4, chunk_rows=7) == brute(x, 4)
    assert found(frame(spark, x), 4) == brute(x, 4)


def test_ties_on_a_grid(spark):
    x = np.array([(i, j) for i in range(9) for j in range(9)], dtype=float)
    assert found(frame(spark, x), 3, chunk_rows=10) == brute(x, 3)


def test_a_third_of_the_rows_are_copies(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(90, 2))
    x[10:40] = x[10]
    x[50:53] = x[50]
    assert found(frame(spark, x), 5, chunk_rows=8) == brute(x, 5)


def test_fewer_rows_than_neighbours(spark):
    x = np.array([[0.0], [1.0], [5.0]])
    assert found(frame(spark, x), 6) == brute(x, 6)
    assert found(frame(spark, x).limit(0), 2) == {}


def test_missing_coordinate_is_an_error(spark):
    df = spark.createDataFrame([(1, 0, [1.0, None]), (2, 0, [1.0, 2.0])], "row_id long, label int, vec array<double>")
    with pytest.raises(Exception, match="coordinate"):
        neighbours.nearest_neighbours(df, 1).collect()


def test_new_rows_lie_on_segments_and_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 2))
    labels = [1] * 12 + [0] * 48
    want = None
    for parts in (1, 5):
        rows = resample.smote_draws(frame(spark, x, labels, parts)).orderBy("row_id").collect()
        got = [(r["row_id"], r["base_id"], r["neighbour_id"], r["u"], tuple(r["vec"])) for r in rows]
        want = want or got
        assert got == want
    assert [w[0] for w in want] == list(range(60, 60 + 36))
    near = {i: [j for j, _ in v] for i, v in brute(x[:12], 6).items()}
    for _, base, end, u, vec in want:
        assert end in near[base] and 0 <= u < 1
        assert np.allclose(vec, x[base] + u * (x[end] - x[base]))
    grown = resample.smote_oversample(frame(spark, x, labels))
    assert {r["label"]: r["count"] for r in grown.groupBy("label").count().collect()} == {0: 48, 1: 48}
    assert grown.filter("synthetic").count() == 36


def test_too_few_minority_rows(spark):
    with pytest.raises(ValueError):
        resample.smote_draws(frame(spark, np.eye(10), [1] * 6 + [0] * 4), k=6, ratio=5.0)


def test_cleaning_needs_all_neighbours_to_agree(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(80, 2))
    labels = (x[:, 0] + rng.normal(size=80) * 0.3 > 0).astype(int)
    near = brute(x, 5)
    agree = {i for i in range(80) if all(labels[j] == labels[i] for j, _ in near[i])}
    both = resample.enn_clean(frame(spark, x, labels), clean_labels=[0, 1])
    assert {r["row_id"] for r in both.collect()} == agree
    one = resample.enn_clean(frame(spark, x, labels), clean_labels=[0])
    assert {r["row_id"] for r in one.collect()} == agree | {i for i in range(80) if labels[i] == 1}


def test_pack_and_unpack(spark):
    df = spark.createDataFrame([(1, 0, 2.0, 3.0)], "row_id long, label int, a double, b double")
    packed = resample.pack(df, ["a", "b"])
    assert packed.first()["vec"] == [2.0, 3.0]
    assert resample.unpack(packed, ["a", "b"]).first() == df.first()


def test_hashed_search_finds_most_with_less_work(spark, monkeypatch):
    rng = np.random.default_rng(12)
    centers = rng.normal(size=(150, 16)) * 4
    x = centers[rng.integers(0, 150, 3000)] + rng.normal(size=(3000, 16)) * 0.3
    x[::100] = x[0]
    df = frame(spark, x, [0] * 3000, 5)
    near = neighbours.hashed_neighbours(df, 5, bucket_rows=30, tables=12)
    got = {r["row_id"]: [n["id"] for n in r["neighbours"]] for r in near.collect()}
    want = {i: [j for j, _ in v] for i, v in brute(x, 5).items()}
    assert got.keys() == want.keys()
    assert np.mean([len(set(got[i]) & set(want[i])) / 5 for i in want]) > 0.9
    again = neighbours.hashed_neighbours(df.repartition(3), 5, bucket_rows=30, tables=12, chunk_rows=16)
    assert {r["row_id"]: [n["id"] for n in r["neighbours"]] for r in again.collect()} == got


def test_hashed_search_in_resampling(spark):
    rng = np.random.default_rng(13)
    x = rng.normal(size=(90, 3))
    labels = [1] * 20 + [0] * 70
    made = resample.smote_draws(frame(spark, x, labels), search=neighbours.hashed_neighbours)
    assert made.count() == 50
    kept = resample.enn_clean(frame(spark, x, labels), [0], search=neighbours.hashed_neighbours)
    assert kept.filter("label = 1").count() == 20


def test_recall_does_not_fall_as_the_table_grows(spark, monkeypatch):
    x = np.random.default_rng(14).normal(size=(1000, 32))
    df = frame(spark, x)
    true = neighbours.neighbour_rows(neighbours.nearest_neighbours(df, 5))
    for cost in ("COPY_PAIRS", "GROUP_PAIRS"):  # so that hashing is chosen on few rows
        monkeypatch.setattr(neighbours, cost, 0, raising=False)
    plans, plan = [], getattr(neighbours, "_plan", None)
    monkeypatch.setattr(neighbours, "_plan", lambda *a: plans.append(plan(*a)) or plans[-1], raising=False)
    near = neighbours.neighbour_rows(neighbours.hashed_neighbours(df, 5, bucket_rows=32))
    hits = true.join(near, ["row_id", "neighbour_id"]).count()
    assert hits / true.count() >= 0.9  # 16 tables find less
    assert plans[0][0] > 1 and plans[0][1] > 0
    measured = neighbours.neighbour_recall(near, true).first()
    assert measured["n"] == 1000 and measured["recall"] == hits / true.count()


def inverted_found(df, k, **options):
    rows = inverted.inverted_neighbours(df, k, **options).collect()
    return {r["row_id"]: [(n["id"], n["distance"]) for n in r["neighbours"]] for r in rows}


def test_inverted_file_with_all_cells_is_exact(spark):
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(6, 3)) * 10
    x = centers[rng.integers(0, 6, 240)] + rng.normal(size=(240, 3))
    x[10:60] = x[10]
    assert inverted_found(frame(spark, x), 4, recall=1.0, group_rows=30, chunk_rows=25) == brute(x, 4)
    assert inverted_found(frame(spark, x + 1e4), 4, recall=1.0, cells=5) == brute(x + 1e4, 4)
    grid = np.array([(i, j) for i in range(9) for j in range(9)], dtype=float)
    assert inverted_found(frame(spark, grid), 3, recall=1.0, group_rows=10) == brute(grid, 3)


def test_inverted_file_finds_nine_in_ten(spark):
    rng = np.random.default_rng(7)
    centers = rng.normal(size=(40, 16)) * 3
    x = centers[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 16))
    got, want = inverted_found(frame(spark, x), 5, group_rows=400), brute(x, 5)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(x)


def test_inverted_file_of_odd_tables(spark):
    assert inverted_found(frame(spark, np.zeros((0, 2))), 3) == {}
    same = np.ones((30, 2))
    assert inverted_found(frame(spark, same), 3) == brute(same, 3)
    assert inverted_found(frame(spark, np.array([[1.0], [2.0]])), 5) == brute(np.array([[1.0], [2.0]]), 5)


def test_vectors_without_structure_are_copied_to_few_groups(spark, monkeypatch):
    """Cells rule nothing out here; a copy for each cell would be some 38 for each vector."""
    x, copies = np.random.default_rng(3).normal(size=(1500, 24)), []
    search = neighbours._search
    monkeypatch.setattr(neighbours, "_search", lambda *a: copies.append(sum(a[4].values())) or search(*a))
    assert found(frame(spark, x), 4, chunk_rows=20) == brute(x, 4)
    assert len(copies) == 2 and copies[0] == len(x) and copies[1] <= 16 * len(x)


def test_all_probes_of_small_groups_copy_a_vector_to_few(spark, monkeypatch):
    x, copies = np.random.default_rng(4).normal(size=(900, 16)), []
    write = inverted.materialize

    def counted(df, name):
        out = write(df, name)
        if name == "probes":
            copies.append(out.selectExpr("sum(size(to))").first()[0] if "to" in out.columns else out.count())
        return out

    monkeypatch.setattr(inverted, "materialize", counted)
    assert inverted_found(frame(spark, x), 4, recall=1.0, group_rows=10, chunk_rows=10) == brute(x, 4)
    assert copies[0] <= 16 * len(x)


def test_copies_of_many_tables_cost_more_than_all_pairs():
    """At 600,000 vectors 256 tables would move each vector 512 times; all pairs move it some 20 times."""
    rows = neighbours._task_rows(600_000, 64, 4_096)
    assert neighbours._work(1, 600_000, rows, neighbours.FAR_COPY) < neighbours._work(256, 128, rows, neighbours.FAR_COPY)


def test_float_error_and_offsets_do_not_change_the_neighbours(spark):
    """Far from zero and in many dimensions, where single precision rules out only what is surely farther."""
    x = np.random.default_rng(5).normal(size=(300, 40)) * 0.01 + 1000.0
    x[::3] = x[0] + np.random.default_rng(6).normal(size=(100, 40)) * 1e-4
    assert found(frame(spark, x), 4, chunk_rows=30) == brute(x, 4)


@pytest.mark.parametrize("d", [1, 2, 4, 8])
def test_boxes_give_the_neighbours_of_all_pairs(spark, monkeypatch, d):
    rng = np.random.default_rng(d)
    x = np.concatenate([np.round(rng.exponential(5, size=(240, d)), 1), rng.integers(0, 3, size=(160, d)), np.full((9, d), 2.5)])
    df = spark.createDataFrame([(int(i), [float(v) for v in row], int(i % 3)) for i, row in zip(rng.permutation(len(x)), x)], "row_id long, vec array<double>, label int")
    want = neighbours.nearest_neighbours(df, 5, label="label").collect()
    monkeypatch.setattr(neighbours, "_place", None)  # the way of cells around pivots
    for rows in (16, 60):
        assert sorted(neighbours.nearest_neighbours(df, 5, label="label", chunk_rows=rows).collect()) == sorted(want)


def test_blocks_find_what_brute_force_finds():
    rng = np.random.default_rng(2)
    for n, d, step in ((700, 3, 0.01), (900, 4, 5.0), (3, 2, 1.0)):
        query, base = (np.round(rng.normal(size=(m, d)) * 10 / step) * step for m in (200, n))
        ids, radius = rng.permutation(3 * n)[:n], rng.random(200) * 9
        for most in (None, radius):
            want = []
            for i, row in enumerate(query):
                away = np.round(np.sqrt(((row - base) ** 2).sum(1)), 6)
                first = [j for j in np.lexsort((ids, away))[:6] if most is None or away[j] <= most[i]]
                want += [(i, j, away[j]) for j in first]
            assert list(zip(*neighbours._best_by_blocks(query, base, ids, 6, most))) == want


def test_boxes_of_a_heavy_value_hold_all_that_is_near():
    rng = np.random.default_rng(3)
    x = np.concatenate([np.full((300, 2), 4.0), rng.normal(size=(300, 2)) * 9])
    boxes = neighbours._Boxes(x[::3], 4)
    mine, radius = boxes.box(x), rng.random(600) * 6
    assert len(np.unique(mine)) > 4 and (x >= boxes.low[mine]).all() and (x <= boxes.high[mine]).all()
    row, box = boxes.reached(x, radius)
    found = set(zip(row.tolist(), box.tolist()))
    close = np.sqrt(((x[:, None] - x) ** 2).sum(2)) <= radius[:, None]
    assert all((i, int(mine[j])) in found for i, j in zip(*np.nonzero(close)))
    assert len(found) < 600 * 16


def test_ids_that_come_twice_give_the_rows_of_one_chunk(spark):
    """A row whose id comes twice has its second copy among its best, which is then left out."""
    x = np.random.default_rng(8).integers(0, 12, size=(150, 3))
    rows = [(i, 0, [float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows + rows[::2], "row_id long, label int, vec array<double>")
    want = neighbours.nearest_neighbours(df, 4).collect()
    assert sorted(neighbours.nearest_neighbours(df, 4, chunk_rows=16).collect()) == sorted(want)
