"""Hard negatives (13) by threshold joins over an inverted index with suffix-norm bounds.

Anchors and rows are dealt into blocks; a cell is one block of anchors against one block of rows,
so the stated queries meet all rows without a cross join and without a row on the driver. In a cell
the dimensions are put in order of their weight. For a threshold t a row lists only its leading
dimensions: from the one on where the norm of the rest is under t / |anchor| it is left out of the
index, since what is left out alone cannot reach t. Lists are walked dimension by dimension,
eight at a time, adding partial scores; after each step the rows go for which partial score plus
the product of the remaining norms is under t for every anchor. What survives is completed from
the dimensions left out and compared exactly. A threshold starts high and is lowered until each
window of the anchor is full or the window's own floor is reached; everything at or over the
threshold has been found by then, so what is kept is exact.

First join: the best ``n_positives`` rows of the anchor's label. Second join: for each of them the
best ``n_negatives`` rows of other labels within a share of its score. A cell returns that many
rows for each window at most, and a window function merges the cells.

Scores are whole numbers: in float64 where products of norms stay under 2^53, else in int64.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.texts import prepare
from basketry.session import ensure_checkpoint_dir

#: Numbers in a block of rows, rows and anchors in a block at most, anchors searched together.
BLOCK_NUMBERS = 1 << 21
BLOCK_ROWS = 1 << 15
BLOCK_ANCHORS = 2048
LEAST_ROWS = 1024
TILE = 128
#: Components beyond this count as this, so that scores of up to 32,768 dimensions fit 64 bits.
LARGEST = 1 << 24
STEP = 8
EXACT = float(1 << 53)
#: Shares of the way from the highest to the lowest threshold that are tried in turn.
LOWERING = (0.1, 0.25, 0.5, 1.0)
SLACK = 1 + 1e-9


def matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of int as rows of a matrix; shorter ones end in zeros."""
    lists = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def suffix_norms(rows: np.ndarray) -> np.ndarray:
    """Norm of each row from each dimension on; the last column is zero."""
    out = np.zeros((len(rows), rows.shape[1] + 1))
    squares = np.square(rows.astype(np.float64))
    out[:, :-1] = np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1])
    return out


class Index:
    """Rows of a block, ready to be searched at any threshold."""

    def __init__(self, rows: np.ndarray):
        self.order = np.argsort(-np.square(rows.astype(np.float64)).sum(axis=0), kind="stable")
        self.rows = rows[:, self.order]
        self.rest = suffix_norms(self.rows)
        self.largest = self.rest[:, 0].max(initial=0.0)

    def search(self, anchors: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(anchor, row, score) of all pairs of a score of ``least`` (one for each anchor) or more."""
        if not len(self.rows) or not len(anchors):
            return
        asked = anchors[:, self.order]
        asked_rest = suffix_norms(asked)
        exact = asked_rest[:, 0].max() * self.largest < EXACT
        kind = np.float64 if exact else np.int64
        asked, rows, rest = asked.astype(kind), self.rows, self.rest
        width = rows.shape[1]
        with np.errstate(divide="ignore", invalid="ignore"):
            bound = np.where(asked_rest[:, 0] > 0, least / asked_rest[:, 0], np.where(least > 0, np.inf, -np.inf)).min()
        # Dimensions in the index: up to where the rest alone is under every anchor's threshold.
        listed = (rest * SLACK >= bound).sum(axis=1) if bound > 0 else np.full(len(rows), width + 1)
        listed = np.minimum(-(-np.minimum(listed, width) // STEP) * STEP, width)
        if bound <= 0:
            listed[:] = width
        alive = np.argsort(-listed, kind="stable")
        alive = alive[: np.count_nonzero(listed)] if width else alive
        partial = np.zeros((len(asked), len(alive)), kind)
        floor = least[:, None]
        for at in range(0, max(width, 1), STEP):
            if not len(alive):
                return
            end = min(at + STEP, width)
            partial += asked[:, at:end] @ rows[alive, at:end].astype(kind).T
            most = partial + asked_rest[:, end, None] * rest[alive, end] * SLACK
            reach = most + 1e-3 >= floor
            over = np.searchsorted(-listed[alive], -end, side="left")  # rows before it have more listed
            if over < len(alive):
                who, which = np.nonzero(reach[:, over:])
                found = alive[over + which]
                score = partial[who, over + which]
                if end < width:
                    score = score + (asked[who, end:] * rows[found, end:]).sum(axis=1)
                kept = score >= least[who]
                yield who[kept], found[kept], score[kept].astype(np.int64)
            keep = np.flatnonzero(reach[:, :over].any(axis=0))
            alive, partial = alive[keep], partial[:, keep]


def _gathered(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _nth(groups: np.ndarray) -> np.ndarray:
    """Position of each element within its run of equal values."""
    if not len(groups):
        return groups
    starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    return np.arange(len(groups)) - np.repeat(starts, np.diff([*starts, len(groups)]))


class Side:
    """Columns of one side of a cell."""

    def __init__(self, table: pa.Table, width: int):
        table = table.combine_chunks()
        numbers = lambda name: table[name].to_numpy()
        self.uid, self.label = numbers("uid"), numbers("label")
        self.unnamed = pc.is_null(table["id"]).to_numpy()
        self.id = pc.fill_null(table["id"], 0).to_numpy()
        self.vectors = matrix(table["vector"], width)

    def ids(self, at: np.ndarray) -> pa.Array:
        return pa.array(self.id[at], pa.int64(), mask=self.unnamed[at])


def _best_first(who: np.ndarray, found: np.ndarray, score: np.ndarray, rows: Side) -> np.ndarray:
    """Order by anchor, falling score, rising id (null ids last)."""
    return np.lexsort((rows.uid[found], rows.id[found], rows.unnamed[found], -score, who))


def positives_of(anchors: Side, rows: Side, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the best ``n`` other rows of each anchor's label in the block."""
    out = []
    for label in np.unique(anchors.label):
        mine = np.flatnonzero(rows.label == label)
        index = Index(rows.vectors[mine])
        asking = np.flatnonzero(anchors.label == label)
        for start in range(0, len(asking), TILE):
            open_ = asking[start : start + TILE]
            norms = suffix_norms(anchors.vectors[open_])[:, 0]
            for share in (0.8, 0.6, 0.4, 0.2, 0.0, None):
                least = np.full(len(open_), -np.inf) if share is None else np.floor(share * norms * index.largest)
                who, found, score = _gathered(list(index.search(anchors.vectors[open_], least)))
                found = mine[found]
                other = rows.uid[found] != anchors.uid[open_[who]]
                who, found, score = who[other], found[other], score[other]
                done = (np.bincount(who, minlength=len(open_)) >= n) | (share is None)
                full = done[who]
                who, found, score = who[full], found[full], score[full]
                order = _best_first(who, found, score, rows)
                order = order[_nth(who[order]) < n]
                out.append((open_[who[order]], found[order], score[order]))
                open_, norms = open_[~done], norms[~done]
                if not len(open_):
                    break
    return _gathered(out)


def negatives_of(
    anchors: Side, rows: Side, windows: np.ndarray, valid: np.ndarray, n: int, shares: tuple[int, int]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, window, row, score) of the best ``n`` rows of other labels in each window of an anchor.

    ``windows``: positive scores (anchors, positives), of which ``valid`` ones count; a row is in a
    window if 100 times its score lies between the two shares of the positive score.
    """
    low, high = (share * windows for share in shares)
    valid = valid & (low <= high)
    asking = np.flatnonzero(valid.any(axis=1))
    index, out = Index(rows.vectors), []
    top = np.where(valid, high, np.iinfo(np.int64).min).max(axis=1) // 100
    bottom = -(-np.where(valid, low, np.iinfo(np.int64).max).min(axis=1) // 100)
    for start in range(0, len(asking), TILE):
        open_ = asking[start : start + TILE]
        for share in LOWERING:
            least = top[open_] - np.ceil(share * (top[open_] - bottom[open_]))
            least = bottom[open_].astype(np.float64) if share == 1.0 else np.maximum(least, bottom[open_])
            parts = []
            for who, found, score in index.search(anchors.vectors[open_], least):
                other = (rows.label[found] != anchors.label[open_[who]]) & (score <= top[open_[who]])
                parts.append((who[other], found[other], score[other]))
            who, found, score = _gathered(parts)
            order = _best_first(who, found, score, rows)
            who, found, score = who[order], found[order], score[order]
            picked, done = [], np.ones(len(open_), bool)
            for k in range(windows.shape[1]):
                at = open_[who]
                inside = valid[at, k] & (100 * score >= low[at, k]) & (100 * score <= high[at, k])
                inside = np.flatnonzero(inside)
                inside = inside[_nth(who[inside]) < n]
                done &= ~valid[open_, k] | (np.bincount(who[inside], minlength=len(open_)) >= n)
                picked.append((inside, np.full(len(inside), k)))
            done |= share == 1.0
            for inside, k in picked:
                kept = done[who[inside]]
                inside, k = inside[kept], k[kept]
                out.append((open_[who[inside]], k, found[inside], score[inside]))
            open_ = open_[~done]
            if not len(open_):
                break
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out))


_PAIR = "anchor_uid long, anchor_id long, k int, positive_id long, positive_score long, uid long, id long, score long"


def _positive_cell(width: int, n: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        anchors, rows = Side(left, width), Side(right, width)
        who, found, score = positives_of(anchors, rows, n)
        return pa.table(
            {
                "anchor_uid": anchors.uid[who],
                "uid": rows.uid[found],
                "id": rows.ids(found),
                "score": score,
            }
        )

    return run


def _negative_cell(width: int, positives: int, n: int, shares: tuple[int, int]):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        anchors, rows = Side(left, width), Side(right, width)
        told = left["positives"].to_pylist()
        scores, valid = np.zeros((len(told), positives), np.int64), np.zeros((len(told), positives), bool)
        names = [[None] * positives for _ in told]
        for i, each in enumerate(told):
            for k, x in enumerate(each):
                scores[i, k], valid[i, k], names[i][k] = x["score"], True, x["id"]
        who, k, found, score = negatives_of(anchors, rows, scores, valid, n, shares)
        return pa.table(
            {
                "anchor_uid": anchors.uid[who],
                "anchor_id": anchors.ids(who),
                "k": pa.array(k, pa.int32()),
                "positive_id": pa.array([names[i][j] for i, j in zip(who.tolist(), k.tolist())], pa.int64()),
                "positive_score": scores[who, k],
                "uid": rows.uid[found],
                "id": rows.ids(found),
                "score": score,
            }
        )

    return run


def whole_vector(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, x as double, held within ``LARGEST``."""
    one = lambda x: F.floor(x.cast("double") * F.lit(float(scale)))
    held = lambda x: F.greatest(F.least(one(x), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int")
    return F.transform(vector, held)


def mine_negatives(
    spark: SparkSession,
    table: DataFrame,
    is_anchor: Column,
    *,
    id: str = "vec_id",  # noqa: A002
    vector: str = "embedding",
    label: str = "label",
    scale: int = 256,
    n_positives: int = 5,
    n_negatives: int = 10,
    shares: tuple[int, int] = (30, 90),
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows for which ``is_anchor`` is true. Rows with a null label or vector, or a
    null or non-finite component, take no part; a row with a null id does (it is last among equal
    scores). A shorter vector ends in zeros; components beyond ``LARGEST`` / ``scale`` count as
    that. A repeated row is another row, also to its anchor, and a repeated anchor is mined again.
    Equal scores go by the smaller id; rows alike in both are interchangeable. An anchor without a
    positive, or a positive below zero, has no negatives. An empty table gives an empty one. Other
    columns are not read, so none can clash.
    """
    prepare(spark)
    folder = f"{ensure_checkpoint_dir(spark)}/negatives-{uuid.uuid4().hex}"
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    table.where(F.col(label).isNotNull() & F.col(vector).isNotNull() & sound).select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(id).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
        whole_vector(F.col(vector), scale).alias("vector"),
    ).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    n, asks, width = rows.agg(
        F.count("*"), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0)), F.coalesce(F.max(F.size("vector")), F.lit(0))
    ).first()
    most = max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // max(width, 1)))
    spread = min(spark.sparkContext.defaultParallelism, -(-n // LEAST_ROWS))
    row_blocks, anchor_blocks = max(1, -(-n // most), spread), max(1, -(-asks // BLOCK_ANCHORS))
    cell = ["anchor_block", "row_block"]

    def dealt(blocks: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    held = rows.select("*", dealt(row_blocks, 1).alias("row_block")).select(
        "*", every(anchor_blocks).alias("anchor_block")
    )
    asking = rows.where("asks").select("*", dealt(anchor_blocks, 2).alias("anchor_block"))

    def meet(anchors: DataFrame, run, schema: str) -> DataFrame:
        each = anchors.select("*", every(row_blocks).alias("row_block"))
        return each.groupBy(*cell).cogroup(held.groupBy(*cell)).applyInArrow(run, schema)

    def first(found: DataFrame, n: int, *group: str) -> DataFrame:
        best = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("id"), "uid")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)

    near = meet(asking, _positive_cell(width, n_positives), "anchor_uid long, uid long, id long, score long")
    near = first(near, n_positives, "anchor_uid").groupBy("anchor_uid")
    near = near.agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positives"))
    asking.join(near, asking["uid"] == near["anchor_uid"]).drop("anchor_uid").write.parquet(f"{folder}/anchors")
    with_positives = spark.read.parquet(f"{folder}/anchors")
    far = meet(with_positives, _negative_cell(width, n_positives, n_negatives, shares), _PAIR)
    return first(far, n_negatives, "anchor_uid", "k").select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
