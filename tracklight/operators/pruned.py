"""Exact best tracks per user without scoring all of them: track blocks by direction, skipped by their bound.

Tracks are put into blocks by their length class and around pivots (tracks drawn by hash) by the nearest direction; a block
knows its largest angle to the pivot and its largest and smallest length, which bound every score with a user from above and
from below. A user first meets the block with the highest bound, then a few more, then all that are left, each time only
blocks whose bound reaches its k-th best score so far. What is skipped cannot be in the list, so lists equal those of a full
product, ties included. A user is copied once per block that it meets, a block once per chunk of such users. The user's k-th
best score so far goes along, and a block returns only tracks that reach it.

Per block only its pivot and four numbers travel to all tasks; their number is bounded by ``PIVOT_BYTES``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklight.operators.ranking import topk_per_user
from tracklight.operators.scoring import CHUNK_CELLS, TIE, _best, block_rows, grid_partitions, matrix, unit_rows
from tracklight.runtime import broadcast_if_small, stage
from tracklight.schema import PREDICTION, RANK, TRACK, USER

PIVOT_BYTES = 64 * 1024 * 1024
#: Shares of the tracks below each border between length classes.
CLASSES = [0.5, 0.8, 0.95]
#: Blocks that a user has met after each round; the last round meets all that the bounds leave.
ROUNDS = (1, 4, 16)
#: Users of a block's chunk at least, where a round has fewer chunks than task slots.
CHUNK_USERS = 1024
#: What rounding may add to an angle and to a score.
ANGLE, SCORE = 1e-7, 2e-9


@dataclass
class Blocks:
    """Direction, largest angle to it, largest and smallest length of every block."""

    pivots: np.ndarray
    angle: np.ndarray
    longest: np.ndarray
    shortest: np.ndarray

    def bounds(self, users: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest possible score of each user (row) with a track of each block (column)."""
        length = np.sqrt((users * users).sum(axis=1, keepdims=True))
        between = np.arccos(np.clip(unit_rows(users) @ self.pivots.T, -1.0, 1.0))
        most, least = np.cos(np.maximum(between - self.angle, 0.0)), np.cos(np.minimum(between + self.angle, np.pi))
        slack = SCORE * (1.0 + length * self.longest)
        upper = length * np.where(most > 0, self.longest, self.shortest) * most + slack
        lower = length * np.where(least < 0, self.longest, self.shortest) * least - slack
        return lower, upper


def _placed(tracks: DataFrame, rows: int, cosine: bool) -> tuple[DataFrame, Blocks]:
    """Tracks with their block, written once, and what is known of the blocks."""
    spark = tracks.sparkSession
    n, width = tracks.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    wanted = min(math.ceil(n / rows / (len(CLASSES) + 1)), PIVOT_BYTES // (8 * max(1, width or 1)))
    drawn = tracks.orderBy(F.xxhash64(F.col(TRACK).cast("bigint"), F.lit(7)), TRACK).limit(max(1, wanted)).select("vector").toArrow()
    pivots = unit_rows(matrix(drawn["vector"]))
    pivots = np.unique(pivots[(pivots * pivots).sum(axis=1) > 0], axis=0)
    shared = spark.sparkContext.broadcast(pivots)

    def nearest(batches):
        directions = shared.value
        for batch in batches:
            v = matrix(batch.column("vector"))
            length = np.sqrt((v * v).sum(axis=1))
            unit = unit_rows(v)
            pivot, angle = np.full(len(v), -1), np.zeros(len(v))
            step = max(1, CHUNK_CELLS // max(1, len(directions)))
            for low in range(0, len(v) if len(directions) else 0, step):
                near = unit[low : low + step] @ directions.T
                best = near.argmax(axis=1)
                pivot[low : low + step] = best
                angle[low : low + step] = np.arccos(np.clip(near[np.arange(len(best)), best], -1.0, 1.0))
            pivot[length == 0], angle[length == 0] = -1, 0.0  # tracks without a direction are a block of their own
            counted = (length > 0).astype(np.float64) if cosine else length
            arrays = [batch.column(TRACK), batch.column("vector"), pa.array(pivot, pa.int32()), pa.array(angle), pa.array(counted), pa.array(length)]
            yield pa.RecordBatch.from_arrays(arrays, [TRACK, "vector", "pivot", "angle", "length", "size"])

    plain = tracks.select(F.col(TRACK).cast("bigint").alias(TRACK), F.col("vector").cast("array<double>").alias("vector"))
    found = stage(plain.mapInArrow(nearest, f"{TRACK} bigint, vector array<double>, pivot int, angle double, length double, size double"), "placed")
    # long tracks apart from short ones: short ones are skipped by their length, and their stray directions widen no cone
    borders = found.where("size > 0").approxQuantile("size", CLASSES, 0.01) or [0.0]
    found = found.withColumn("class", sum(((F.col("size") > b).cast("int") for b in borders), F.lit(0)))
    # one row per pivot and class; one with more tracks than a block holds has several blocks
    sizes = {(r["pivot"], r["class"]): math.ceil(r["n"] / rows) for r in found.groupBy("pivot", "class").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, total = {}, 0
    for key in sorted(sizes):
        first[key], total = total, total + sizes[key]
    table = spark.createDataFrame([(*key, first[key], sizes[key]) for key in first], "pivot int, class int, first int, parts int")
    block = (F.col("first") + F.pmod(F.xxhash64(F.col(TRACK)), F.col("parts"))).cast("int").alias("track_block")
    found = found.join(F.broadcast(table), ["pivot", "class"]).select(TRACK, "vector", block, "pivot", "angle", "length")
    known = found.groupBy("track_block").agg(*[f(c).alias(n) for f, c, n in ((F.max, "angle", "angle"), (F.max, "length", "longest"), (F.min, "length", "shortest"), (F.first, "pivot", "pivot"))])
    blocks = Blocks(np.zeros((total, pivots.shape[1] if pivots.size else width or 1)), np.zeros(total), np.zeros(total), np.zeros(total))
    for r in known.collect():
        i = r["track_block"]
        blocks.angle[i], blocks.longest[i], blocks.shortest[i] = r["angle"] + ANGLE, r["longest"], r["shortest"]
        if r["pivot"] >= 0:
            blocks.pivots[i] = pivots[r["pivot"]]
    return found.select(TRACK, "vector", "track_block"), blocks


def _visits(users: DataFrame, blocks: Blocks, begin: int, end: int, cosine: bool, band: tuple[float, float] | None) -> DataFrame:
    """(user, track_block, kth): blocks ``begin`` to ``end`` of each user's order of bounds that can still add to its list."""
    shared = users.sparkSession.sparkContext.broadcast(blocks)

    def tasks(batches):
        known = shared.value
        for batch in batches:
            ids, u = batch.column(USER).to_numpy(), matrix(batch.column("vector"))
            u = unit_rows(u) if cosine else u
            kth = batch.column("kth").to_numpy(zero_copy_only=False)
            step = max(1, CHUNK_CELLS // max(1, len(known.angle)))
            for low in range(0, len(ids), step):
                least, most = known.bounds(u[low : low + step])
                order = np.argsort(-most, axis=1, kind="stable")[:, begin:end]
                best = np.take_along_axis(most, order, axis=1)
                open_ = best >= kth[low : low + step, None]
                if band is not None:
                    open_ &= (best > band[0]) & (np.take_along_axis(least, order, axis=1) < band[1])
                rows, cols = np.nonzero(open_)
                arrays = [pa.array(ids[low + rows], pa.int64()), pa.array(order[rows, cols], pa.int32()), pa.array(kth[low + rows])]
                yield pa.RecordBatch.from_arrays(arrays, [USER, "track_block", "kth"])

    return users.select(USER, "vector", "kth").mapInArrow(tasks, f"{USER} bigint, track_block int, kth double")


def _scored(tracks: DataFrame, users: DataFrame, visits: DataFrame, seen: DataFrame | None, k: int, rows: int, cosine: bool, band, high_track_first: bool) -> DataFrame:
    """The best ``k`` tracks of every visited block for the users that visit it, as far as they reach the user's ``kth``."""
    # users of a round may all meet the same few blocks: their chunks are as many as keep all task slots busy
    slots = tracks.sparkSession.sparkContext.defaultParallelism
    users_of_chunk = min(rows, max(CHUNK_USERS, math.ceil(visits.count() / (2 * slots))))
    chunks = visits.groupBy("track_block").agg(F.ceil(F.count(F.lit(1)) / users_of_chunk).cast("int").alias("chunks"))
    chunks = F.broadcast(stage(chunks, "chunks"))  # one row per block
    grid = ["track_block", "chunk"]
    right = visits.join(chunks, "track_block").withColumn("chunk", F.pmod(F.xxhash64(USER), F.col("chunks")).cast("int")).drop("chunks")
    if seen is not None:
        right = right.join(seen, [USER, "track_block"], "left")
    else:
        right = right.withColumn("seen", F.lit(None).cast("array<bigint>"))
    right = right.join(users.select(USER, "vector"), USER)  # last, so that vectors are sent once per visit
    left = tracks.join(chunks, "track_block").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    partitions = grid_partitions(tracks.sparkSession, 1 << 20)
    right, left = (side.repartition(partitions, *grid) for side in (right.select(USER, "vector", "seen", "kth", *grid), left.select(TRACK, "vector", *grid)))

    def cell(track_rows: pa.Table, user_rows: pa.Table) -> pa.Table:
        out = []
        if len(track_rows) and len(user_rows):
            track_rows = track_rows.sort_by(TRACK)
            track_ids, v = track_rows[TRACK].to_numpy(), matrix(track_rows["vector"])
            user_ids, u = user_rows[USER].to_numpy(), matrix(user_rows["vector"])
            kth = user_rows["kth"].to_numpy()
            if cosine:
                u, v = unit_rows(u), unit_rows(v)
            step = max(1, CHUNK_CELLS // len(track_ids))
            for low in range(0, len(user_ids), step):
                scores = u[low : low + step] @ v.T
                if band is not None:
                    rounded = np.round(scores, TIE)
                    scores[(rounded <= band[0]) | (rounded >= band[1])] = -np.inf
                own = user_rows["seen"].slice(low, step).combine_chunks()
                row = np.repeat(np.arange(len(own)), pa.compute.fill_null(own.value_lengths(), 0).to_numpy(zero_copy_only=False))
                ids = own.flatten().to_numpy(zero_copy_only=False)
                at = np.minimum(np.searchsorted(track_ids, ids), len(track_ids) - 1)
                met = track_ids[at] == ids
                scores[row[met], at[met]] = -np.inf
                rows_, cols, values, _ = _best(scores, k, high_track_first, kth[low : low + step])
                out.append(pa.table({USER: user_ids[low + rows_], TRACK: track_ids[cols], PREDICTION: values}))
        kinds = pa.schema([(USER, pa.int64()), (TRACK, pa.int64()), (PREDICTION, pa.float64())])
        return pa.concat_tables([*(t.cast(kinds) for t in out), kinds.empty_table()])

    return left.groupBy(*grid).cogroup(right.groupBy(*grid)).applyInArrow(cell, f"{USER} bigint, {TRACK} bigint, {PREDICTION} double")


def pruned_lists(
    users: DataFrame,
    tracks: DataFrame,
    k: int,
    *,
    seen: DataFrame | None = None,
    vector: str = "vector",
    cosine: bool = False,
    band: tuple[float, float] | None = None,
    high_track_first: bool = False,
    rows_per_block: int | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """Best ``k`` tracks per user as ``(user, track, prediction, rank)``, and how many cells of a user and a block were scored
    (``visited``) of all (``possible``)."""
    user_type, track_type = users.schema[USER].dataType.simpleString(), tracks.schema[TRACK].dataType.simpleString()
    width = tracks.agg(F.max(F.size(vector))).first()[0] or 1
    rows = rows_per_block or block_rows(width)
    placed, blocks = _placed(tracks.select(TRACK, F.col(vector).alias("vector")), rows, cosine)
    if seen is not None:  # a list holds at most the tracks of one block
        pairs = seen.where(F.col(USER).isNotNull() & F.col(TRACK).isNotNull()).select(F.col(USER).cast("bigint").alias(USER), F.col(TRACK).cast("bigint").alias(TRACK))
        where = placed.select(TRACK, "track_block")
        pairs = pairs.join(broadcast_if_small(where, placed.count(), 16), TRACK)
        seen = stage(pairs.groupBy(USER, "track_block").agg(F.collect_set(TRACK).alias("seen")), "seen")
    state = users.select(F.col(USER).cast("bigint").alias(USER), F.col(vector).cast("array<double>").alias("vector"))
    state = stage(state, "users")
    n_users, total = state.count(), len(blocks.angle)
    lists, visited, begin = None, 0, 0
    none = F.lit(float("-inf"))
    current = state.withColumn("kth", none)
    for end in (*(r for r in ROUNDS if r < total), total):
        visits = stage(_visits(current, blocks, begin, end, cosine, band), "visits")
        visited += visits.count()
        found = _scored(placed, state, visits, seen, k, rows, cosine, band, high_track_first)
        if lists is not None:
            found = found.unionByName(lists.select(USER, TRACK, PREDICTION))
        lists, begin = stage(topk_per_user(found, k, high_track_first), "lists"), end
        kth = lists.where(F.col(RANK) == k).select(USER, F.col(PREDICTION).alias("kth"))
        current = state.join(broadcast_if_small(kth, n_users, 16), USER, "left").withColumn("kth", F.coalesce("kth", none))
    out = lists.select(F.col(USER).cast(user_type).alias(USER), F.col(TRACK).cast(track_type).alias(TRACK), PREDICTION, RANK)
    return out, {"visited": visited, "possible": n_users * total}
