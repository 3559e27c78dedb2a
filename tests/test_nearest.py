"""Nearest rows against the full matrix of distances."""

import numpy as np
import pytest

from strata.operators.nearest import _Cuts, nearest

SCHEMA = "id long, v array<double>"


def plain(asked, rows, k):
    out = set()
    for q, x in asked:
        near = sorted((float(np.sqrt(sum((a - b) ** 2 for a, b in zip(y, x, strict=True)))), h) for h, y in rows if h != q)
        out |= {(q, h, round(d, 9), i + 1) for i, (d, h) in enumerate(near[:k])}
    return out


def found(df):
    rows = [(r["query_id"], r["neighbor_id"], round(r["distance"], 9), r["rank"]) for r in df.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


@pytest.mark.parametrize("k", [1, 4])
def test_equals_the_full_matrix_with_hot_copies_and_many_blocks(spark, k):
    r = np.random.default_rng(k)
    x = np.round(np.vstack([r.normal(c, 0.3, (60, 3)) for c in (0, 4, 9)]), 2)
    x[100:160] = x[100]  # a third of the rows are copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    asked = rows[::3] + [(1000 + i, v.tolist()) for i, v in enumerate(np.round(r.normal(5, 4, (40, 3)), 2))]
    got = nearest(spark.createDataFrame(asked, SCHEMA), spark.createDataFrame(rows, SCHEMA), "id", "v", k,
                  pivots=9, rings=3, tile=7, block=5)
    assert found(got) == plain(asked, rows, k)


def test_small_history_and_rows_without_use(spark):
    rows = [(1, [0.0, 0.0]), (2, [3.0, 4.0]), (3, None), (4, [float("nan"), 1.0]), (5, [1.0, None]), (None, [0.0, 1.0]),
            (6, []), (7, [float("inf"), 0.0])]
    asked = [(1, [0.0, 0.0]), (9, [3.0, 3.0]), (10, None), (11, [1.0])]
    got = nearest(spark.createDataFrame(asked, SCHEMA), spark.createDataFrame(rows, SCHEMA), "id", "v", 3)
    use = [r for r in rows if r[0] in (1, 2)]
    assert found(got) == plain(asked[:2], use, 3)


def test_empty_tables(spark):
    none, one = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, [0.5])], SCHEMA)
    assert nearest(one, none, "id", "v").count() == 0
    assert nearest(none, one, "id", "v").count() == 0
    assert nearest(one, one, "id", "v").count() == 0


def test_cells_grow_in_number_and_not_in_size_and_requests_meet_few():
    r = np.random.default_rng(3)
    visited = {}
    for n in (4000, 32000):
        x = r.normal(size=(n, 2))
        cuts = _Cuts(x[::4], max(4, -(-(n // 4) // (n // 64))))
        cell = cuts.place(x)
        held = np.bincount(cell, minlength=cuts.cells)
        assert held.max() < 4 * 64
        known = np.unique(cell)
        cuts.boxes(known, np.array([x[cell == c].min(axis=0) for c in known]), np.array([x[cell == c].max(axis=0) for c in known]))
        near = np.array([np.sort(np.hypot(*(x - q).T))[3] for q in x[:200]])
        who, met = cuts.within(x[:200], near)
        visited[n] = held[met].sum() / 200
        assert {(i, c) for i in range(200) for c in cell[np.hypot(*(x - x[i]).T) <= near[i]]} <= set(zip(who, met, strict=True))
    assert visited[32000] < 1.5 * visited[4000] < 1.5 * 500
