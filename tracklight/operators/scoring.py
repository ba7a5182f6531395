"""Exact scoring of every user against every track without listing the pairs.

Users and tracks are hashed into blocks. Each cell of the block grid is one task that multiplies a
user block with a track block in memory, masks what the user has seen and returns only the best k
tracks per user; the lists of the cells are then merged per user. Block sizes are bounded, so memory
per task does not grow with the data, and a user with very many seen tracks is spread over the cells.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklight.operators.ranking import topk_per_user
from tracklight.schema import PREDICTION, RANK, TRACK, USER

BLOCK_BYTES = 64 * 1024 * 1024
MAX_BLOCK_ROWS = 65_536
CHUNK_CELLS = 4_000_000
CELL_PAIRS = 5_000_000
TIE = 9  # scores equal to nine places are ties, decided by track id


def matrix(column) -> np.ndarray:
    """A list column without nulls as a two-dimensional array."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def list_column(rows: np.ndarray) -> pa.Array:
    """The rows of a two-dimensional array as a list column."""
    offsets = np.arange(0, rows.size + 1, max(1, rows.shape[1]), dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, np.ascontiguousarray(rows, dtype=np.float64).ravel())


def dot_scores(users: np.ndarray, tracks: np.ndarray) -> np.ndarray:
    return users @ tracks.T


def unit_rows(m: np.ndarray) -> np.ndarray:
    length = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def cosine_scores(users: np.ndarray, tracks: np.ndarray) -> np.ndarray:
    return unit_rows(users) @ unit_rows(tracks).T


def _log_norm(scores: np.ndarray) -> np.ndarray:
    top = scores.max(axis=1)
    return top + np.log(np.exp(scores - top[:, None]).sum(axis=1))


def _reached(scores: np.ndarray, k: int) -> np.ndarray:
    """Per row a score that at least ``k`` cells reach, the k-th best one or a little less: the k-th best maximum of groups of cells."""
    width = scores.shape[1]
    group = min(64, width // (4 * k))
    if group < 2:
        return np.partition(scores, width - k, axis=1)[:, width - k]
    n = width // group
    maxima = scores[:, : n * group].reshape(len(scores), group, n).max(axis=1)
    return np.partition(maxima, n - k, axis=1)[:, n - k]


def _best(scores: np.ndarray, k: int, high_track_first: bool, floor: np.ndarray | None = None):
    """Row, column, rounded score and 1-based position of the best k finite cells of each row.

    With ``floor``, a rounded score per row, only cells that reach it.
    """
    least = _reached(scores, k) if k < scores.shape[1] else np.full(len(scores), -np.inf)
    if floor is not None:
        least = np.maximum(least, floor)
    rows, cols = np.nonzero(scores >= (least - 2e-9)[:, None])
    values = scores[rows, cols]
    finite = np.isfinite(values)
    rows, cols, values = rows[finite], cols[finite], np.round(values[finite], TIE)
    if floor is not None:
        reached = values >= floor[rows]
        rows, cols, values = rows[reached], cols[reached], values[reached]
    order = np.lexsort((-cols if high_track_first else cols, -values, rows))
    rows, cols, values = rows[order], cols[order], values[order]
    position = np.arange(len(rows)) - np.searchsorted(rows, rows)
    keep = position < k
    return rows[keep], cols[keep], values[keep], position[keep] + 1


def block_rows(width: int) -> int:
    return int(max(1, min(MAX_BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, width)))))


def grid_partitions(spark, cells: int) -> int:
    """Shuffle partitions of a grid: a few per task slot; a task takes its cells one after the other."""
    slots = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(1, min(cells, 4 * slots))


def _shape(df: DataFrame, vector: str) -> tuple[int, int]:
    row = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("width")).first()
    return row["n"], row["width"] or 1


def grid_shape(
    users: DataFrame, tracks: DataFrame, seen: DataFrame | None = None, vector: str = "vector", rows: int | None = None
) -> tuple[int, int]:
    """Numbers of user blocks and track blocks.

    A cell holds at most ``rows`` users and tracks, on average at most CELL_PAIRS seen pairs, and there
    are enough cells for all task slots. Ids are hashed, so a user with very many seen tracks spreads
    over all track blocks and a track seen by many over all user blocks.
    """
    n_users, width = _shape(users, vector)
    n_tracks, _ = _shape(tracks, vector)
    rows = rows or block_rows(width)
    track_blocks = max(1, math.ceil(n_tracks / rows))
    slots = users.sparkSession.sparkContext.defaultParallelism
    pairs = seen.count() if seen is not None else 0
    wanted = (n_users / rows, 2 * slots / track_blocks, pairs / (CELL_PAIRS * track_blocks))
    return max(1, min(math.ceil(max(wanted)), n_users)), track_blocks


def block_of(key: str, blocks: int):
    return F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(blocks)).cast("int")


def best_unseen(
    users: DataFrame,
    tracks: DataFrame,
    k: int,
    *,
    seen: DataFrame | None = None,
    vector: str = "vector",
    score: Callable[[np.ndarray, np.ndarray], np.ndarray] = dot_scores,
    band: tuple[float, float] | None = None,
    softmax: bool = False,
    high_track_first: bool = False,
    rows_per_block: int | None = None,
) -> DataFrame:
    """Best ``k`` tracks per user as ``(user, track, prediction, rank)``.

    ``users`` and ``tracks`` hold an id and ``vector``; ``seen`` lists the pairs to leave out. With
    ``band`` only scores strictly between the two limits count. With ``softmax`` the prediction is
    the probability over all tracks, seen ones included.

    Where the tracks fill several blocks, users meet only those that can reach their list (``pruned_lists``); a softmax needs
    every score and runs over the whole grid.
    """
    user_type = users.schema[USER].dataType.simpleString()
    track_type = tracks.schema[TRACK].dataType.simpleString()
    user_blocks, track_blocks = grid_shape(users, tracks, seen, vector, rows_per_block)
    if track_blocks > 1 and not softmax and score in (dot_scores, cosine_scores):
        from tracklight.operators.pruned import pruned_lists

        lists, _ = pruned_lists(
            users, tracks, k, seen=seen, vector=vector, cosine=score is cosine_scores, band=band, high_track_first=high_track_first, rows_per_block=rows_per_block
        )
        return lists
    partitions = grid_partitions(users.sparkSession, user_blocks * track_blocks)
    grid = ["track_block", "user_block"]

    as_vector = F.col(vector).cast("array<double>").alias("vector")
    left = (
        tracks.select(block_of(TRACK, track_blocks).alias("track_block"), F.col(TRACK).cast("bigint").alias(TRACK), as_vector)
        .withColumn("user_block", F.explode(F.sequence(F.lit(0), F.lit(user_blocks - 1))))
        .repartition(partitions, *grid)
    )
    right = (
        users.select(block_of(USER, user_blocks).alias("user_block"), F.col(USER).cast("bigint").alias(USER), as_vector)
        .withColumn("track_block", F.explode(F.sequence(F.lit(0), F.lit(track_blocks - 1))))
        .withColumn(TRACK, F.lit(None).cast("bigint"))
    )
    if seen is not None:
        pairs = seen.where(F.col(USER).isNotNull() & F.col(TRACK).isNotNull()).select(
            block_of(USER, user_blocks).alias("user_block"),
            F.col(USER).cast("bigint").alias(USER),
            F.lit(None).cast("array<double>").alias("vector"),
            block_of(TRACK, track_blocks).alias("track_block"),
            F.col(TRACK).cast("bigint").alias(TRACK),
        )
        right = right.unionByName(pairs)
    right = right.repartition(partitions, *grid)

    def score_cell(track_rows: pa.Table, user_rows: pa.Table) -> pa.Table:
        out = {USER: [], TRACK: [], PREDICTION: [], RANK: [], "block": [], "log_norm": []}
        known = user_rows.filter(pa.compute.is_null(user_rows[TRACK]))
        masked = user_rows.filter(pa.compute.is_valid(user_rows[TRACK]))
        if len(known) and len(track_rows):
            track_ids = track_rows[TRACK].to_numpy()
            user_ids = known[USER].to_numpy()
            by_track, by_user = np.argsort(track_ids), np.argsort(user_ids)
            track_ids, user_ids = track_ids[by_track], user_ids[by_user]
            v, u = matrix(track_rows["vector"])[by_track], matrix(known["vector"])[by_user]
            block = track_rows["track_block"][0].as_py()

            mask_user, mask_track = masked[USER].to_numpy(), masked[TRACK].to_numpy()
            r = np.minimum(np.searchsorted(user_ids, mask_user), len(user_ids) - 1)
            c = np.minimum(np.searchsorted(track_ids, mask_track), len(track_ids) - 1)
            both = (user_ids[r] == mask_user) & (track_ids[c] == mask_track)
            r, c = r[both], c[both]
            by_row = np.argsort(r, kind="stable")
            r, c = r[by_row], c[by_row]

            step = max(1, CHUNK_CELLS // len(track_ids))
            for low in range(0, len(user_ids), step):
                high = min(low + step, len(user_ids))
                s = score(u[low:high], v)
                norms = _log_norm(s) if softmax else np.zeros(high - low)
                if band is not None:
                    rounded = np.round(s, TIE)
                    s[(rounded <= band[0]) | (rounded >= band[1])] = -np.inf
                a, b = np.searchsorted(r, [low, high])
                s[r[a:b] - low, c[a:b]] = -np.inf
                rows, cols, values, position = _best(s, k, high_track_first)
                out[USER].append(user_ids[low + rows])
                out[TRACK].append(track_ids[cols])
                out[PREDICTION].append(values)
                out[RANK].append(position)
                out["block"].append(np.full(len(rows), block))
                out["log_norm"].append(norms[rows])
                if softmax:  # one row without a track carries the norm of users with nothing left
                    bare = np.setdiff1d(np.arange(high - low), rows)
                    out[USER].append(user_ids[low + bare])
                    out[TRACK].append(np.full(len(bare), -1))
                    out[PREDICTION].append(np.zeros(len(bare)))
                    out[RANK].append(np.zeros(len(bare), dtype=np.int64))
                    out["block"].append(np.full(len(bare), block))
                    out["log_norm"].append(norms[bare])
        kinds = {USER: np.int64, TRACK: np.int64, PREDICTION: np.float64, RANK: np.int32, "block": np.int32, "log_norm": np.float64}
        return pa.table(
            {n: np.concatenate(out[n]).astype(t) if out[n] else np.zeros(0, dtype=t) for n, t in kinds.items()}
        )

    scored = (
        left.groupBy(*grid)
        .cogroup(right.groupBy(*grid))
        .applyInArrow(
            score_cell,
            f"{USER} bigint, {TRACK} bigint, {PREDICTION} double, {RANK} int, block int, log_norm double",
        )
    )
    if softmax:
        # one norm per user and track block
        norms = scored.groupBy(USER, "block").agg(F.max("log_norm").alias("log_norm"))
        total = norms.groupBy(USER).agg(F.collect_list("log_norm").alias("norms"))
        top = F.array_max("norms")
        sums = F.aggregate("norms", F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
        total = total.select(USER, (top + F.log(sums)).alias("total"))
        scored = scored.where(F.col(RANK) > 0).join(total, USER)
        scored = scored.withColumn(PREDICTION, F.exp(F.col(PREDICTION) - F.col("total")))
    scored = scored.select(F.col(USER).cast(user_type).alias(USER), F.col(TRACK).cast(track_type).alias(TRACK), PREDICTION, RANK)
    if track_blocks > 1:
        scored = topk_per_user(scored.drop(RANK), k, high_track_first)
    return scored
