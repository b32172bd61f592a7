"""Hard negatives against full scans in whole numbers."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from curveloom.llm import negatives, queries
from curveloom.llm.common import read

SMALL, LARGE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


def brute(rows, every_nth=50, n_positive=5, n_negative=3):
    """All results by scoring every row with every anchor."""
    usable = set()
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * float(x)) for x in v)))
    out = []
    for i, label, v in usable:
        if i % every_nth:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, own) for j, own, w in usable if j != i and len(w) == len(v))
        for p, j, _ in [s for s in scored if s[2] == label][:n_positive]:
            fits = [(n, k) for n, k, own in scored if own != label and 50 * -p <= 100 * -n <= 95 * -p]
            out += [(i, j, rank, k, -p, -n) for rank, (n, k) in enumerate(fits[:n_negative], 1)]
    return sorted(out)


def tuples(df):
    return sorted(tuple(r) for r in df.collect())


def collected(df):
    return [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]


@pytest.mark.parametrize("folder", [SMALL, LARGE])
def test_negatives_equal_a_full_scan(spark, folder):
    found = queries.op13_negatives(spark, folder)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert tuples(found) == brute(collected(read(spark, folder, "embeddings")))


def clustered(n, d=6, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((8, d)) * 2
    return [(i, (middle[i % 8] + rng.standard_normal(d) * 0.2).tolist(), int(rng.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("clusters, row_block, anchor_block", [(1, 1 << 21, 1 << 17), (5, 1 << 21, 1 << 17), (8, 150, 12)])
def test_cells_and_blocks_change_no_result(spark, monkeypatch, clusters, row_block, anchor_block):
    monkeypatch.setattr(negatives, "ROW_BLOCK", row_block)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", anchor_block)
    rows = clustered(600)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert tuples(negatives.mined(frame, every_nth=20, clusters=clusters)) == brute(rows, 20)


def test_cells_rule_out_most_cells_of_clustered_rows(spark):
    x = np.array([v for _, v, _ in clustered(4000)])
    cells = negatives.Cells(negatives.centres_of(x, 8))
    angles, norm = cells.angles(x), np.linalg.norm(x, axis=1)
    home = angles.argmin(axis=1)
    cells.farthest = np.array([angles[home == c, c].max() for c in range(8)])
    cells.longest = np.array([norm[home == c].max() for c in range(8)])
    fifth = np.sort(x[:400] @ x.T, axis=1)[:, -6]
    visits = cells.others(x[:400], home[:400], fifth)
    assert np.mean([len(v) for v in visits]) < 2
    scores = x[:400] @ x.T
    for row, open_ in enumerate(visits):
        assert set(home[scores[row] >= fifth[row]]) <= {home[row], *open_}


def test_a_walk_ends_before_the_list_does():
    rng = np.random.default_rng(0)
    v = np.floor(256 * np.array([v for _, v, _ in clustered(8000)]))
    rows = pd.DataFrame({"vec_id": np.arange(8000), "label": np.zeros(8000, np.int64), "vector": list(v)})
    slot = [{"slot": 0, "lower": negatives.LEAST, "upper": negatives.MOST, "least": negatives.LEAST}]
    asked = rows.iloc[0:160:8].assign(row=np.arange(20), slots=[slot] * 20)
    found, compared = negatives.walk(asked, rows.iloc[rng.permutation(8000)], 5, True, chunk=64)
    assert compared < 0.4 * 20 * 8000
    for row, at in enumerate(range(0, 160, 8)):
        order = sorted((-int(s), j) for j, s in enumerate(v @ v[at]) if j != at)[:5]
        mine = found[found["row"] == row]
        assert [(-s, j) for s, j in zip(mine["score"], mine["found"])] == order


def test_negatives_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (50, [0.3, -0.2], 2), (1, [1.0, 0.5], 1), (2, [1.0, 0.5], 1), (3, [0.9, 0.1], 2),
            (4, None, 1), (5, [1.0, None], 1), (6, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [1.0], 1), (10, [0.7], 2), (None, [1.0, 1.0], 1),
            (11, [0.9, 0.2], None), (100, [0.0, 0.0], 3), (12, [0.0, 0.0], 3), (13, [0.9, 0.1], 2), (14, [0.9, 0.1], 0), (15, [0.8, 0.1], 3),
            (150, [2.0], 1), (200, [], 1), (16, [], 1), (17, [], 4), (0, [0.1, 0.9], 2), (250, [1e14, 1.0], 5), (18, [1e14, -3.0], 5),
            (19, [7e13, 0.0], 6), (20, [-1.0, 0.5], 1), (21, [0.5, 0.3], 7)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, row int, rank string")
    expected = [tuple(min(max(x, -2 ** 63), 2 ** 63 - 1) for x in r) for r in brute(rows)]
    small = [r for r in expected if abs(r[4]) < 2 ** 62]
    for clusters in (1, 3):
        found = tuples(negatives.mined(frame, clusters=clusters))
        assert [r for r in found if abs(r[4]) < 2 ** 62] == small
    assert negatives.mined(frame.limit(0)).count() == 0
    assert negatives.mined(frame.where("vec_id = 1")).count() == 0


def test_many_ties_and_one_label(spark):
    rows = [(i, [1.0, 1.0] if i % 3 else [0.9, 0.8], 4 if i % 5 else 2) for i in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    stored = [(r["vec_id"], r["embedding"], r["label"]) for r in frame.collect()]
    assert tuples(negatives.mined(frame, clusters=2)) == brute(stored)
