"""Hard negatives against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import hard_negatives as hn
from basketry.llm.queries import llm_queries
from tests.conftest import SF_DIR

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, uid long, positives int"
LAST = (1, 0)


def brute(rows, anchor=lambda i: i % 100 == 0, scale=256, n_positives=5, n_negatives=10, shares=(30, 90)):
    """(anchor, positive, rank, negative, positive score, negative score) with counts."""
    taken = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        whole = [max(-hn.LARGEST, min(hn.LARGEST, int(np.floor(float(np.float32(x)) * scale)))) for x in vector]
        taken.append((vec_id, whole, label))
    key = lambda x: (-x[0], LAST if x[1] is None else (0, x[1]))
    found = Counter()
    for at, (anchor_id, mine, label) in enumerate(taken):
        if anchor_id is None or not anchor(anchor_id):
            continue
        scored = [
            (sum(a * b for a, b in zip(mine, v)), i, other) for k, (i, v, other) in enumerate(taken) if k != at
        ]
        same = sorted((x for x in scored if x[2] == label), key=key)[:n_positives]
        others = sorted((x for x in scored if x[2] != label), key=key)
        for score, positive, _ in same:
            inside = [x for x in others if shares[0] * score <= 100 * x[0] <= shares[1] * score][:n_negatives]
            for rank, (negative_score, negative, _) in enumerate(inside, 1):
                found[anchor_id, positive, rank, negative, score, negative_score] += 1
    return found


def mined(df):
    return Counter(map(tuple, df.collect()))


def relabelled(rows):
    return [(i, v, (c + 1) % 10 if i is not None and i % 7 == 0 and c is not None else c) for i, v, c in rows]


def read(spark, folder):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]


def clusters(n: int, dims: int, seed: int, labels: int = 4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims))
    out = []
    for i in range(n):
        label = int(rng.integers(labels))
        vector = rng.normal(scale=0.7, size=dims) + centres[label] * rng.choice([0.2, 1.0])
        out.append((i, [float(x) for x in vector / np.linalg.norm(vector)], label))
    return out


def test_query_against_brute_force(spark):
    got = llm_queries()["op13_negatives"](spark, SF_DIR)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert mined(got) == brute(relabelled(read(spark, SF_DIR)))


@pytest.mark.parametrize("block_rows, block_anchors, tile", [(37, 3, 2), (1000, 50, 128)])
def test_any_blocks_give_the_same(spark, monkeypatch, block_rows, block_anchors, tile):
    rows = clusters(240, 19, 1)
    rows += [(500 + k, rows[0][1], 3) for k in range(80)]  # a third of all rows are one vector
    monkeypatch.setattr(hn, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(hn, "BLOCK_ANCHORS", block_anchors)
    monkeypatch.setattr(hn, "TILE", tile)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    got = hn.mine_negatives(spark, table, F.col("vec_id") % 20 == 0)
    assert mined(got) == brute(rows, lambda i: i % 20 == 0)


def test_odd_rows(spark):
    rng = random.Random(2)
    vector = lambda n=6: [rng.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(n)]
    rows = [(i, vector(), rng.randrange(3)) for i in range(60)]  # very many ties
    rows += [rows[0], rows[0], rows[10], (None, vector(), 1), (None, vector(), 2)]
    rows += [(100, None, 1), (200, vector(), None), (300, [0.1, None, 0.2], 1), (None, None, None)]
    rows += [(400, [float("nan")] * 6, 1), (500, [float("inf")] + [0.0] * 5, 1), (600, [], 1), (700, [0.0] * 6, 2)]
    rows += [(800, vector(3), 0), (900, vector(9), 0), (1000, [1e30, -1e30], 1), (1001, [2e5] * 4, 2), (-100, vector(), 0)]
    table = spark.createDataFrame([(*r, "x", 7, 1) for r in rows], SCHEMA).repartition(3)
    got = hn.mine_negatives(spark, table, F.col("vec_id") % 10 == 0)
    assert mined(got) == brute(rows, lambda i: i % 10 == 0)
    assert hn.mine_negatives(spark, table.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hn.mine_negatives(spark, table, F.lit(False)).count() == 0


@pytest.mark.parametrize("scale", [1, 1 << 30])
def test_search_finds_every_pair_over_a_threshold(scale):
    rng = np.random.default_rng(3)
    rows = (rng.normal(size=(300, 21)) * rng.exponential(size=21) * 100).astype(np.int64) * scale
    anchors = rows[:9] + scale
    index = hn.Index(rows)
    scores = anchors @ rows.T
    for q in (0.0, 0.5, 0.9, 0.99, 1.0):
        least = np.quantile(scores, q, axis=1).astype(np.float64)
        found = {(i, j): s for part in index.search(anchors, least) for i, j, s in zip(*(x.tolist() for x in part))}
        expected = {(i, j): int(scores[i, j]) for i, j in zip(*np.nonzero(scores >= least[:, None]))}
        assert found == expected


def test_the_index_leaves_dimensions_out_and_rows_go_early(monkeypatch):
    """A high threshold multiplies far fewer numbers than all."""
    rng = np.random.default_rng(4)
    rows = (rng.normal(size=(4000, 64)) * 0.9 ** np.arange(64) * 1000).astype(np.int64)
    index, anchors = hn.Index(rows), rows[:1]
    work = []
    real = np.searchsorted
    monkeypatch.setattr(hn.np, "searchsorted", lambda a, *b, **c: work.append(len(a)) or real(a, *b, **c))
    high = np.array([0.9 * float(anchors[0] @ anchors[0])])
    assert sum(len(x[0]) for x in index.search(anchors, high)) >= 1
    assert sum(work) < 4000 * 64 / hn.STEP / 3
