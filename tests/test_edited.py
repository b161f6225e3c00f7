from __future__ import annotations

import numpy as np
import pytest

from panelwise.operators import edited, neighbours, resample
from tests.test_neighbours import frame


def kept(df):
    return sorted(r["row_id"] for r in df.collect())


def table(seed, n, d, spread, copies=0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(8, d)) * spread
    at = rng.integers(0, 8, n)
    x = centers[at] + rng.normal(size=(n, d))
    y = np.where(rng.random(n) < 0.1, rng.integers(0, 3, n), at % 3)
    if copies:
        x[:copies] = x[0]
        x[copies : copies + 9] = np.round(x[copies : copies + 9])
        y[:copies] = rng.integers(0, 2, copies)
    return x, y


@pytest.mark.parametrize("seed,n,d,spread,copies,labels", [
    (1, 300, 3, 4, 0, [0, 1, 2]), (2, 300, 2, 1, 0, [0]), (3, 260, 3, 4, 40, [0, 1, 2]), (4, 200, 6, 0.2, 7, [1, 2]),
])
def test_same_rows_as_the_full_search(spark, seed, n, d, spread, copies, labels):
    x, y = table(seed, n, d, spread, copies)
    df = frame(spark, x, y)
    want = kept(resample.enn_clean(df, labels, 4))
    assert kept(edited.clean_by_two_radii(df, labels, 4, chunk_rows=20)) == want
    assert kept(edited.clean_by_two_radii(df, labels, 4)) == want


def test_ties_on_a_grid(spark):
    x = np.array([(i, j) for i in range(8) for j in range(8)], dtype=float)
    df = frame(spark, x, [(i + j) % 5 == 0 for i in range(8) for j in range(8)])
    assert kept(edited.clean_by_two_radii(df, [0, 1], 3, chunk_rows=10)) == kept(resample.enn_clean(df, [0, 1], 3))


def test_few_rows_one_label_and_no_rows(spark):
    few = frame(spark, np.array([[0.0], [1.0], [5.0]]), [0, 0, 1])
    for k in (1, 2, 6):
        assert kept(edited.clean_by_two_radii(few, [0, 1], k)) == kept(resample.enn_clean(few, [0, 1], k))
    one = frame(spark, np.zeros((4, 1)))
    assert kept(edited.clean_by_two_radii(one, [0], 2)) == [0, 1, 2, 3]
    assert kept(edited.clean_by_two_radii(few.limit(0), [0], 2)) == []
    assert kept(edited.clean_by_two_radii(few, [7], 2)) == [0, 1, 2]


def test_fewer_distances(spark, monkeypatch):
    x, y = table(9, 1500, 4, 6)
    df, full = frame(spark, x, y), []
    search = neighbours._search

    def counted(queries, base, k, chunk_rows, n_query, n_base):
        full.append(sum(n * n_base[c] for c, n in n_query.items() if c in n_base))
        return search(queries, base, k, chunk_rows, n_query, n_base)

    monkeypatch.setattr(neighbours, "_search", counted)
    want, tally = kept(resample.enn_clean(df, [0, 1, 2], 5, search=lambda *a: neighbours.nearest_neighbours(*a, chunk_rows=64))), {}
    assert kept(edited.clean_by_two_radii(df, [0, 1, 2], 5, chunk_rows=64, tally=tally)) == want
    assert 1.4 * tally["compared"] < sum(full)
    assert 2 * (tally["compared"] - full[0]) < full[1]


def test_rows_without_structure_are_copied_to_few_groups(spark, monkeypatch):
    """A copy for each part of a cell would be some 19 for each row and label here."""
    rng, copies, write = np.random.default_rng(7), [], edited.materialize
    x, y = rng.normal(size=(1500, 24)), rng.integers(0, 2, 1500)

    def counted(df, name):
        out = write(df, name)
        if name == "visits":
            copies.append(out.selectExpr("coalesce(max(size(to)), 0)").first()[0])
        return out

    monkeypatch.setattr(edited, "materialize", counted)
    df = frame(spark, x, y)
    assert kept(edited.clean_by_two_radii(df, [0, 1], 4, chunk_rows=20)) == kept(resample.enn_clean(df, [0, 1], 4))
    assert copies and max(copies) <= 16
