"""A network from profiles to a softmax over tracks: one relu layer, and weights and a bias for each track.

The loss is the mean cross-entropy of the heard pairs. An epoch runs in cells of a user block and a track block: the softmax of a
cell runs over all tracks of its block, whose exact log-norm it has at hand. Tracks are hashed into blocks anew in
every epoch, so a block is a uniform sample of the tracks and its correction for the sampling, the same for all of its
tracks, cancels; with one block the softmax is exact. Cells add up gradients per track and per row of the
first layer, and only these sums are shuffled. The first layer is one small table; tracks stay distributed.
Steps are scaled by the root of the summed squared gradients of each row, as in pairwise ranking.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklight.functions.vectors import random_vector, sum_of
from tracklight.models.bpr import _moved
from tracklight.operators.scoring import CHUNK_CELLS, best_unseen, block_of, grid_partitions, grid_shape, list_column, matrix
from tracklight.runtime import Relay, stage
from tracklight.schema import TRACK, USER


def hidden_layer(x: np.ndarray, layer: np.ndarray) -> np.ndarray:
    """Relu units of profiles, and a last column of ones that meets the tracks' biases. The last row of ``layer`` is its bias."""
    found = np.maximum(x @ layer[:-1, :-1] + layer[-1, :-1], 0.0)
    return np.hstack([found, np.ones((len(x), 1))])


def cell_gradients(x: np.ndarray, layer: np.ndarray, v: np.ndarray, user: np.ndarray, track: np.ndarray, pairs: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Gradients that raise the likelihood, for the layer and the tracks of a cell, and the cell's loss; all divided by ``pairs``.

    ``user`` and ``track`` are the rows of the heard pairs.
    """
    gl, gv, loss = np.zeros_like(layer), np.zeros_like(v), 0.0
    order = np.argsort(user, kind="stable")
    user, track = user[order], track[order]
    heard = np.bincount(user, minlength=len(x)).astype(np.float64)
    some = np.flatnonzero(heard)  # users without a pair in this block add nothing
    step = max(1, CHUNK_CELLS // max(1, len(v)))
    for low in range(0, len(some), step):
        own = some[low : low + step]
        begin, end = np.searchsorted(user, [own[0], own[-1] + 1])
        h = hidden_layer(x[own], layer)
        logits = h @ v.T
        top = logits.max(axis=1, keepdims=True)
        share = np.exp(logits - top)
        norm = share.sum(axis=1, keepdims=True)
        rows = np.searchsorted(own, user[begin:end])
        loss += float((np.log(norm) + top)[rows, 0].sum() - logits[rows, track[begin:end]].sum())
        back = share * (-heard[own][:, None] / norm)
        np.add.at(back, (rows, track[begin:end]), 1.0)
        gv += back.T @ h
        inner = (back @ v)[:, :-1] * (h[:, :-1] > 0)
        gl[:-1, :-1] += x[own].T @ inner
        gl[-1, :-1] += inner.sum(axis=0)
    return gl / pairs, gv / pairs, loss / pairs


class SoftmaxModel:
    """``layer`` (inputs and bias x units and a column of zeros) and the tracks' ``(track, vector)``; ``losses`` by epoch."""

    def __init__(self, layer: np.ndarray, tracks: DataFrame, losses: list[float]):
        self.layer, self.tracks, self.losses = layer, tracks, losses

    def tastes(self, profiles: DataFrame) -> DataFrame:
        """``(user, vector)`` of the hidden layer, whose product with a track's vector is the logit."""
        layer, kind = self.layer, profiles.schema[USER].dataType.simpleString()

        def tasks(batches):
            for batch in batches:
                x = matrix(batch.column("vector")) if batch.num_rows else np.zeros((0, len(layer) - 1))
                yield pa.RecordBatch.from_arrays([batch.column(USER), list_column(hidden_layer(x, layer))], [USER, "vector"])

        return profiles.select(USER, F.col("vector").cast("array<double>").alias("vector")).mapInArrow(tasks, f"{USER} {kind}, vector array<double>")

    def recommend(self, profiles: DataFrame, train: DataFrame, k: int) -> DataFrame:
        """Best ``k`` unseen tracks with their probability among all tracks, those without training rows left out."""
        return best_unseen(self.tastes(profiles), self.tracks, k, seen=train, softmax=True, high_track_first=True)


def fit(train: DataFrame, profiles: DataFrame, units: int = 128, epochs: int = 20, rate: float = 0.1, seed: int = 42, rows_per_block: int | None = None) -> SoftmaxModel:
    """Trains on the heard pairs of ``train`` whose user has a profile ``(user, vector)``."""
    spark = train.sparkSession
    pairs = stage(train.select(USER, TRACK).distinct().join(profiles.select(USER), USER, "left_semi"), "softmax-pairs")
    n_pairs = float(max(1, pairs.count()))
    users = stage(profiles.select(USER, F.col("vector").cast("array<double>").alias("vector")), "softmax-users")
    width = users.agg(F.max(F.size("vector"))).first()[0] or 1
    rng = np.random.default_rng(seed)
    limit = np.sqrt(6.0 / (width + units))
    layer = np.zeros((width + 1, units + 1))
    layer[:-1, :-1] = rng.uniform(-limit, limit, (width, units))
    power = np.zeros(width + 1)
    tracks = pairs.select(TRACK).distinct().select(
        TRACK, F.concat(random_vector(units, 2.0 * limit, -0.5, F.lit("s"), F.col(TRACK), seed), F.array(F.lit(0.0))).alias("vector"), F.lit(0.0).alias("power")
    )
    steps, sums = Relay(spark, "softmax-tracks"), Relay(spark, "softmax-gradients")
    tracks = steps.write(tracks)
    shape = grid_shape(users, tracks, pairs, rows=rows_per_block)
    losses = []
    for epoch in range(epochs):
        cells = _epoch(users, tracks, pairs, shape, layer, n_pairs, epoch)
        found = sums.write(cells.groupBy("side", "id").agg(sum_of("g", units + 1).alias("g")))
        own = found.where("side <> 'track'").toArrow()  # the first layer and the loss: one row per input
        gradient = np.zeros_like(layer)
        for side, row, g in zip(own["side"].to_pylist(), own["id"].to_pylist(), matrix(own["g"]) if len(own) else []):
            if side == "loss":
                losses.append(float(g[0]))
            else:
                gradient[row] = g
        power += (gradient * gradient).sum(axis=1)
        layer = layer + rate / np.sqrt(power + 1e-12)[:, None] * gradient
        for_track = found.where("side = 'track'").select(F.col("id").cast(tracks.schema[TRACK].dataType).alias(TRACK), "g")
        tracks = steps.write(_moved(tracks, for_track, TRACK, units, rate))
    return SoftmaxModel(layer, tracks.select(TRACK, "vector"), losses)


def _epoch(users: DataFrame, tracks: DataFrame, pairs: DataFrame, shape: tuple[int, int], layer: np.ndarray, n_pairs: float, epoch: int) -> DataFrame:
    """(side, id, g): sums of a cell for tracks, rows of the layer and, in the first element, the loss."""
    user_blocks, track_blocks = shape
    spark, grid = users.sparkSession, ["track_block", "user_block"]
    partitions = grid_partitions(spark, user_blocks * track_blocks)
    track_block = F.pmod(F.xxhash64(F.col(TRACK).cast("bigint"), F.lit(epoch).cast("bigint")), F.lit(track_blocks)).cast("int").alias("track_block")
    user_block = block_of(USER, user_blocks).alias("user_block")
    left = tracks.select(track_block, F.col(TRACK).cast("bigint").alias(TRACK), "vector").withColumn("user_block", F.explode(F.sequence(F.lit(0), F.lit(user_blocks - 1))))
    right = users.select(user_block, F.col(USER).cast("bigint").alias(USER), "vector").withColumn("track_block", F.explode(F.sequence(F.lit(0), F.lit(track_blocks - 1))))
    right = right.withColumn(TRACK, F.lit(None).cast("bigint"))
    heard = pairs.select(user_block, F.col(USER).cast("bigint").alias(USER), F.lit(None).cast("array<double>").alias("vector"), track_block, F.col(TRACK).cast("bigint").alias(TRACK))
    left, right = (side.repartition(partitions, *grid) for side in (left, right.unionByName(heard)))
    shared = spark.sparkContext.broadcast(layer)
    kinds = pa.schema([("side", pa.string()), ("id", pa.int64()), ("g", pa.list_(pa.float64()))])

    def cell(track_rows: pa.Table, user_rows: pa.Table) -> pa.Table:
        known = user_rows.filter(pa.compute.is_null(user_rows[TRACK]))
        heard = user_rows.filter(pa.compute.is_valid(user_rows[TRACK]))
        if not (len(known) and len(heard) and len(track_rows)):
            return kinds.empty_table()
        known, track_rows = known.sort_by(USER), track_rows.sort_by(TRACK)
        ids = track_rows[TRACK].to_numpy()
        rows = np.searchsorted(known[USER].to_numpy(), heard[USER].to_numpy())
        gl, gv, loss = cell_gradients(matrix(known["vector"]), shared.value, matrix(track_rows["vector"]), rows, np.searchsorted(ids, heard[TRACK].to_numpy()), n_pairs)
        told = np.zeros((1, gl.shape[1]))
        told[0, 0] = loss
        sides = ["track"] * len(ids) + ["layer"] * len(gl) + ["loss"]
        number = np.concatenate([ids, np.arange(len(gl)), [0]])
        return pa.table([pa.array(sides), pa.array(number), list_column(np.vstack([gv, gl, told]))], schema=kinds)

    return left.groupBy(*grid).cogroup(right.groupBy(*grid)).applyInArrow(cell, "side string, id bigint, g array<double>")
