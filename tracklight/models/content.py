"""Content-based lists: tracks whose features are close to the user's profile."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklight.operators.features import (
    feature_width,
    profile_means,
    profile_medians,
    to_vectors,
    track_features,
)
from tracklight.operators.scoring import CHUNK_CELLS, TIE, block_of, best_unseen, cosine_scores, dot_scores, grid_partitions, grid_shape, matrix, unit_rows
from tracklight.runtime import stage
from tracklight.schema import PREDICTION, RANK, TRACK, USER

#: Chosen sets of a block of ``spread_out``, on average at most.
SETS = 4096


def encode(catalogue: DataFrame, numeric: list[str] | None = None) -> tuple[DataFrame, DataFrame, int]:
    """Long features, dense vectors ``(track, vector)`` and their width, both written once."""
    width = feature_width(catalogue, numeric)
    features = stage(track_features(catalogue, numeric), "features")
    return features, stage(to_vectors(features, TRACK, width), "vectors"), width


def profiles(train: DataFrame, features: DataFrame, width: int, kind: str = "mean") -> DataFrame:
    """``(user, vector)`` by ``kind``: mean, median, weighted or weighted_normalised."""
    if kind == "median":
        long = profile_medians(train, features)
    elif kind in ("mean", "weighted", "weighted_normalised"):
        long = profile_means(train, features, weighted=kind != "mean", normalised=kind == "weighted_normalised")
    else:
        raise ValueError(f"unknown profile: {kind}")
    return to_vectors(long, USER, width)


def known_tracks(vectors: DataFrame, train: DataFrame, test: DataFrame) -> DataFrame:
    """Track vectors of tracks that occur in train or test."""
    known = train.select(TRACK).unionByName(test.select(TRACK)).distinct()
    return vectors.join(known, TRACK, "left_semi")


def recommend_similar(
    users: DataFrame, vectors: DataFrame, train: DataFrame, test: DataFrame, k: int, reference_truncation: bool = False
) -> DataFrame:
    """Best ``k`` unseen known tracks by cosine with the profile; of equal ones the higher id first.

    With ``reference_truncation`` the list is cut to k plus the user's number of train rows before seen
    and unknown tracks are dropped, so it can come out shorter.
    """
    if not reference_truncation:
        known = known_tracks(vectors, train, test)
        return best_unseen(users, known, k, seen=train, score=cosine_scores, high_track_first=True)
    return _truncated(users, vectors, train, test, k)


def _truncated(users: DataFrame, vectors: DataFrame, train: DataFrame, test: DataFrame, k: int) -> DataFrame:
    """The cut made first: of the best k unseen known tracks, those placed within k + seen among all tracks.

    Before a track of the list come those listed before it, and tracks that are seen or unknown: only these are counted.
    """
    candidates = stage(recommend_similar(users, vectors, train, test, k), "candidates")
    n_seen = train.groupBy(USER).agg(F.count(F.lit(1)).alias("n_seen"))
    others = _others_before(users, vectors, candidates, train, test)
    placed = candidates.join(others, USER, "left").join(n_seen, USER)
    passed = F.aggregate(F.filter("others", lambda x: x["place"] < F.col(RANK)), F.lit(0).cast("bigint"), lambda n, x: n + x["n"])
    before = F.col(RANK) - 1 + F.coalesce(passed, F.lit(0))
    return placed.where(before < k + F.col("n_seen")).select(USER, TRACK, PREDICTION, RANK)


def _places(scores: np.ndarray, ids: np.ndarray, listed_scores: np.ndarray, listed_ids: np.ndarray) -> np.ndarray:
    """How many tracks of its user's list come before each track; a row of the lists for each track."""
    return ((listed_scores > scores[:, None]) | ((listed_scores == scores[:, None]) & (listed_ids > ids[:, None]))).sum(axis=1)


def _others_before(users: DataFrame, vectors: DataFrame, candidates: DataFrame, train: DataFrame, test: DataFrame) -> DataFrame:
    """``(user, others)``: how many seen or unknown tracks ``n`` come after the first ``place`` tracks of the user's list and before the next."""
    user_type = candidates.schema[USER].dataType.simpleString()
    seen = train.select(USER, TRACK).where(F.col(USER).isNotNull() & F.col(TRACK).isNotNull()).distinct()
    user_blocks, track_blocks = grid_shape(users, vectors, seen)
    partitions, grid = grid_partitions(users.sparkSession, user_blocks * track_blocks), ["track_block", "user_block"]
    known = train.select(TRACK).unionByName(test.select(TRACK)).distinct().withColumn("known", F.lit(True))
    listed = candidates.groupBy(USER).agg(F.sort_array(F.collect_list(F.struct(RANK, TRACK, PREDICTION))).alias("l"))
    left = (
        vectors.join(known, TRACK, "left")
        .select(block_of(TRACK, track_blocks).alias("track_block"), F.col(TRACK).cast("bigint").alias(TRACK), F.col("vector").cast("array<double>"), F.coalesce("known", F.lit(False)).alias("known"))
        .withColumn("user_block", F.explode(F.sequence(F.lit(0), F.lit(user_blocks - 1))))
        .repartition(partitions, *grid)
    )
    right = users.join(listed, USER).select(
        block_of(USER, user_blocks).alias("user_block"),
        F.col(USER).cast("bigint").alias(USER),
        F.lit(None).cast("bigint").alias(TRACK),
        F.col("vector").cast("array<double>").alias("vector"),
        F.col(f"l.{TRACK}").cast("array<bigint>").alias("ids"),
        F.col(f"l.{PREDICTION}").alias("scores"),
        F.explode(F.sequence(F.lit(0), F.lit(track_blocks - 1))).alias("track_block"),
    )
    none = lambda kind: F.lit(None).cast(kind)
    pairs = seen.select(
        block_of(USER, user_blocks).alias("user_block"), F.col(USER).cast("bigint").alias(USER), F.col(TRACK).cast("bigint").alias(TRACK),
        none("array<double>").alias("vector"), none("array<bigint>").alias("ids"), none("array<double>").alias("scores"), block_of(TRACK, track_blocks).alias("track_block"),
    )
    right = right.unionByName(pairs).repartition(partitions, *grid)
    kinds = pa.schema([(USER, pa.int64()), ("place", pa.int32()), ("n", pa.int64())])

    def count(track_rows: pa.Table, user_rows: pa.Table) -> pa.Table:
        with_list = user_rows.filter(pa.compute.is_valid(user_rows["vector"])).sort_by(USER)
        if not (len(track_rows) and len(with_list)):
            return kinds.empty_table()
        track_rows = track_rows.sort_by(TRACK)
        track_ids, v, u = track_rows[TRACK].to_numpy(), unit_rows(matrix(track_rows["vector"])), unit_rows(matrix(with_list["vector"]))
        user_ids, length = with_list[USER].to_numpy(), pa.compute.list_value_length(with_list["ids"]).to_numpy()
        # lists side by side; a short one ends in places that nothing reaches
        most = int(length.max())
        listed_scores, listed_ids = np.full((len(u), most), -np.inf), np.full((len(u), most), -1, dtype=np.int64)
        filled = np.arange(most)[None, :] < length[:, None]
        listed_scores[filled] = with_list["scores"].combine_chunks().flatten().to_numpy()
        listed_ids[filled] = with_list["ids"].combine_chunks().flatten().to_numpy()
        last = listed_scores[np.arange(len(u)), length - 1]
        found = np.zeros((len(u), most), dtype=np.int64)

        def add(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
            near = scores >= last[rows]
            rows, ids, scores = rows[near], ids[near], scores[near]
            step = max(1, CHUNK_CELLS // most)
            for low in range(0, len(rows), step):
                own = rows[low : low + step]
                place = _places(scores[low : low + step], ids[low : low + step], listed_scores[own], listed_ids[own])
                within = place < length[own]
                np.add.at(found, (own[within], place[within]), 1)

        heard = user_rows.filter(pa.compute.is_valid(user_rows[TRACK]))
        rows = np.minimum(np.searchsorted(user_ids, heard[USER].to_numpy()), len(user_ids) - 1)
        cols = np.minimum(np.searchsorted(track_ids, heard[TRACK].to_numpy()), len(track_ids) - 1)
        both = (user_ids[rows] == heard[USER].to_numpy()) & (track_ids[cols] == heard[TRACK].to_numpy())
        rows, cols = rows[both], cols[both]
        step = max(1, CHUNK_CELLS // v.shape[1])
        for low in range(0, len(rows), step):
            r, c = rows[low : low + step], cols[low : low + step]
            add(r, track_ids[c], np.round(np.einsum("ij,ij->i", u[r], v[c]), TIE))
        unknown = np.flatnonzero(~track_rows["known"].to_numpy(zero_copy_only=False))
        step = max(1, CHUNK_CELLS // max(1, len(unknown)))
        for low in range(0, len(u) if len(unknown) else 0, step):
            scores = np.round(u[low : low + step] @ v[unknown].T, TIE)
            r, c = np.nonzero(scores >= last[low : low + step, None])
            add(low + r, track_ids[unknown[c]], scores[r, c])
        r, place = np.nonzero(found)
        return pa.table({USER: user_ids[r], "place": place.astype(np.int32), "n": found[r, place]}, schema=kinds)

    counted = left.groupBy(*grid).cogroup(right.groupBy(*grid)).applyInArrow(count, f"{USER} bigint, place int, n bigint")
    return counted.groupBy(F.col(USER).cast(user_type).alias(USER)).agg(F.collect_list(F.struct("place", "n")).alias("others"))


def similar_in_range(
    users: DataFrame, vectors: DataFrame, k: int, low: float = 0.5, high: float = 0.7, seen: DataFrame | None = None
) -> DataFrame:
    """Best ``k`` tracks whose cosine with the profile lies strictly between ``low`` and ``high``."""
    return best_unseen(users, vectors, k, seen=seen, score=cosine_scores, band=(low, high), high_track_first=True)


def spread_out(
    users: DataFrame,
    vectors: DataFrame,
    n: int = 10,
    band: tuple[float, float] | None = None,
    rows_per_block: int | None = None,
) -> DataFrame:
    """Greedy varied lists ``(user, track, prediction, rank)``.

    The first track is the best match; each next one has the smallest largest-cosine to those chosen so
    far, equal ones by match and then by higher id. With ``band`` the choice is among the best ``n`` tracks
    inside it, otherwise among all tracks. Exact for any number of tracks: if they fill several blocks, the first
    tracks are lists of one, and every next step is a pass over the block grid with the sets chosen so far, which many users may
    share. Only users of sets with different tracks equally far meet the tracks one by one, for their own match decides.
    """
    if band is not None:
        return _spread_shortlist(similar_in_range(users, vectors, n, *band), vectors, n)
    user_blocks, track_blocks = grid_shape(users, vectors, rows=rows_per_block)
    grid = ["track_block", "user_block"]
    partitions = grid_partitions(users.sparkSession, user_blocks * track_blocks)
    user_type, track_type = (df.schema[c].dataType.simpleString() for df, c in ((users, USER), (vectors, TRACK)))
    left = (
        vectors.select(block_of(TRACK, track_blocks).alias("track_block"), F.col(TRACK).cast("bigint").alias(TRACK), F.col("vector").cast("array<double>"))
        .withColumn("user_block", F.explode(F.sequence(F.lit(0), F.lit(user_blocks - 1))))
        .repartition(partitions, *grid)
    )
    empty = F.array().cast("array<array<double>>")
    state = users.select(
        block_of(USER, user_blocks).alias("user_block"),
        F.col(USER).cast("bigint").alias(USER),
        F.col("vector").cast("array<double>").alias("vector"),
        F.array().cast("array<bigint>").alias("chosen"),
        empty.alias("chosen_vectors"),
    )
    steps = n if track_blocks == 1 else 1

    def choose(track_rows: pa.Table, user_rows: pa.Table) -> pa.Table:
        found = {USER: [], TRACK: [], PREDICTION: [], "largest": [], "step": [], "vector": []}
        if len(track_rows) and len(user_rows):
            ids = track_rows[TRACK].to_numpy()
            order = np.argsort(ids)[::-1]
            ids, raw = ids[order], matrix(track_rows["vector"])[order]
            v = unit_rows(raw)
            u = unit_rows(matrix(user_rows["vector"]))
            chosen, chosen_vectors = user_rows["chosen"].to_pylist(), user_rows["chosen_vectors"].to_pylist()
            place = {t: p for p, t in enumerate(ids)}
            for row, user in enumerate(user_rows[USER].to_pylist()):
                match = np.round(v @ u[row], TIE)
                largest = np.full(len(ids), -np.inf)
                if chosen_vectors[row]:
                    largest = (v @ unit_rows(np.array(chosen_vectors[row])).T).max(axis=1)
                taken = [place[t] for t in chosen[row] if t in place]
                for step in range(steps):
                    if len(taken) == len(ids):
                        break
                    rounded = np.round(largest, TIE)
                    rounded[taken] = np.inf
                    ties = np.flatnonzero(rounded == rounded.min())
                    pick = ties[np.argmax(match[ties])]
                    found[USER].append(user)
                    found[TRACK].append(ids[pick])
                    found[PREDICTION].append(match[pick])
                    found["largest"].append(rounded[pick])
                    found["step"].append(len(chosen[row]) + step + 1)
                    found["vector"].append(raw[pick])
                    taken.append(pick)
                    largest = np.maximum(largest, v @ v[pick])
        return pa.table(
            {
                USER: pa.array(found[USER], pa.int64()),
                TRACK: pa.array(found[TRACK], pa.int64()),
                PREDICTION: pa.array(found[PREDICTION], pa.float64()),
                "largest": pa.array(found["largest"], pa.float64()),
                "step": pa.array(found["step"], pa.int32()),
                "vector": pa.array(found["vector"], pa.list_(pa.float64())),
            }
        )

    schema = f"{USER} bigint, {TRACK} bigint, {PREDICTION} double, largest double, step int, vector array<double>"

    def one_pass(now: DataFrame) -> DataFrame:
        right = now.withColumn("track_block", F.explode(F.sequence(F.lit(0), F.lit(track_blocks - 1)))).repartition(partitions, *grid)
        return left.groupBy(*grid).cogroup(right.groupBy(*grid)).applyInArrow(choose, schema)

    typed = lambda df: df.select(
        F.col(USER).cast(user_type).alias(USER), F.col(TRACK).cast(track_type).alias(TRACK), PREDICTION, F.col("step").alias(RANK)
    )
    if track_blocks == 1:
        return typed(one_pass(state))
    picks = []
    best = F.min(F.struct("largest", (-F.col(PREDICTION)).alias("worse"), (-F.col(TRACK)).alias("lower"), "step", "vector")).alias("b")
    every_pair = lambda now: one_pass(now).groupBy(USER).agg(best).select(
        USER, (-F.col("b.lower")).alias(TRACK), (-F.col("b.worse")).alias(PREDICTION), F.col("b.step").alias("step"), F.col("b.vector").alias("picked")
    )
    plain = vectors.select(F.col(TRACK).cast("bigint").alias(TRACK), F.col("vector").cast("array<double>").alias("picked"))
    for turn in range(1, n + 1):
        if turn == 1:
            first = best_unseen(state.select(USER, "vector"), vectors, 1, score=cosine_scores, high_track_first=True, rows_per_block=rows_per_block)
            found = first.select(USER, F.col(TRACK).cast("bigint").alias(TRACK), PREDICTION, F.lit(1).alias("step")).join(plain, TRACK)
        else:
            found, open_ = _picked_by_set(state, vectors, turn, rows_per_block)
            if open_.limit(1).count():
                found = found.unionByName(every_pair(open_))
        step = stage(found.select(USER, TRACK, PREDICTION, "step", "picked"), "picks")
        picks.append(step)
        state = stage(
            state.join(step.select(USER, TRACK, "picked"), USER).select(
                "user_block", USER, "vector",
                F.array_append("chosen", F.col(TRACK)).alias("chosen"),
                F.array_append("chosen_vectors", F.col("picked")).alias("chosen_vectors"),
            ),
            "chosen",
        )
    total = picks[0]
    for step in picks[1:]:
        total = total.unionByName(step)
    return typed(total)


def _matches(rows: DataFrame) -> DataFrame:
    """``rows`` (user, track, step, picked, vector) with the match of the picked track in place of ``vector``."""

    def tasks(batches):
        for batch in batches:
            if batch.num_rows:
                u, v = unit_rows(matrix(batch.column("vector"))), unit_rows(matrix(batch.column("picked")))
                match = np.round(np.einsum("ij,ij->i", u, v), TIE)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (USER, TRACK)), pa.array(match), batch.column("step"), batch.column("picked")], [USER, TRACK, PREDICTION, "step", "picked"])

    return rows.select(USER, TRACK, "step", "picked", "vector").mapInArrow(tasks, f"{USER} bigint, {TRACK} bigint, {PREDICTION} double, step int, picked array<double>")


def _picked_by_set(state: DataFrame, vectors: DataFrame, turn: int, rows_per_block: int | None) -> tuple[DataFrame, DataFrame]:
    """Picks (user, track, prediction, step, picked) of users whose chosen set has one farthest track, and the rows of the others.

    Equal tracks count as one, of which every user takes the one with the highest id.
    """
    spark = state.sparkSession
    state = state.withColumn("set", F.array_join(F.array_sort("chosen").cast("array<string>"), ","))
    sets = stage(state.groupBy("set").agg(F.first("chosen").alias("chosen"), F.first("chosen_vectors").alias("chosen_vectors")), "sets")
    _, track_blocks = grid_shape(vectors.select(F.col(TRACK).alias(USER), "vector"), vectors, rows=rows_per_block)
    set_blocks = max(1, math.ceil(sets.count() / SETS), math.ceil(2 * spark.sparkContext.defaultParallelism / track_blocks))
    grid = ["track_block", "set_block"]
    partitions = grid_partitions(spark, set_blocks * track_blocks)
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = vectors.select(block_of(TRACK, track_blocks).alias("track_block"), F.col(TRACK).cast("bigint").alias(TRACK), F.col("vector").cast("array<double>").alias("vector"))
    left = left.withColumn("set_block", every(set_blocks)).repartition(partitions, *grid)
    right = sets.withColumn("set_block", F.pmod(F.xxhash64("set"), F.lit(set_blocks)).cast("int")).withColumn("track_block", every(track_blocks)).repartition(partitions, *grid)
    kinds = pa.schema([("set", pa.string()), ("largest", pa.float64()), (TRACK, pa.int64()), ("vector", pa.list_(pa.float64()))])

    def farthest(track_rows: pa.Table, set_rows: pa.Table) -> pa.Table:
        if not (len(track_rows) and len(set_rows)):
            return kinds.empty_table()
        ids = track_rows[TRACK].to_numpy()
        order = np.argsort(ids)[::-1]
        ids, raw = ids[order], matrix(track_rows["vector"])[order]
        v, place = unit_rows(raw), {t: p for p, t in enumerate(ids.tolist())}
        names, chosen = set_rows["set"].to_pylist(), set_rows["chosen"].to_pylist()
        units = np.array([unit_rows(np.array(vs, dtype=float)) for vs in set_rows["chosen_vectors"].to_pylist()])
        out = {"set": [], "largest": [], TRACK: [], "vector": []}
        step = max(1, CHUNK_CELLS // len(ids))
        for low in range(0, len(names), step):
            some = units[low : low + step]
            largest = some[:, 0] @ v.T
            for j in range(1, some.shape[1]):
                np.maximum(largest, some[:, j] @ v.T, out=largest)
            rounded = np.round(largest, TIE)
            for row, own in enumerate(chosen[low : low + step]):
                rounded[row, [place[t] for t in own if t in place]] = np.inf
            least = rounded.min(axis=1)
            for row in np.flatnonzero(np.isfinite(least)):
                ties = np.flatnonzero(rounded[row] == least[row])
                other = ties[(raw[ties] != raw[ties[0]]).any(axis=1)]
                for pick in (ties[0], *other[:1]):
                    out["set"].append(names[low + row])
                    out["largest"].append(least[row])
                    out[TRACK].append(ids[pick])
                    out["vector"].append(raw[pick])
        return pa.table(out, schema=kinds)

    found = stage(left.groupBy(*grid).cogroup(right.groupBy(*grid)).applyInArrow(farthest, f"set string, largest double, {TRACK} bigint, vector array<double>"), "farthest")
    least = found.groupBy("set").agg(F.min("largest").alias("least"))
    ties = found.join(least, "set").where(F.col("largest") == F.col("least")).groupBy("set")
    ties = stage(ties.agg(F.max(TRACK).alias(TRACK), F.first("vector").alias("picked"), F.count_distinct("vector").alias("n")), "ties")
    alone = ties.where("n = 1").select("set", TRACK, "picked")
    picks = _matches(state.select(USER, "vector", "set").join(alone, "set").withColumn("step", F.lit(turn)))
    return picks, state.join(ties.where("n > 1").select("set"), "set", "left_semi").drop("set")


def _spread_shortlist(shortlist: DataFrame, vectors: DataFrame, n: int) -> DataFrame:
    """The greedy choice within lists of at most ``n`` tracks, one user row at a time."""
    user_type, track_type = (shortlist.schema[c].dataType.simpleString() for c in (USER, TRACK))
    rows = shortlist.join(vectors.select(TRACK, "vector"), TRACK)
    lists = rows.groupBy(USER).agg(F.array_sort(F.collect_list(F.struct(RANK, TRACK, PREDICTION, "vector"))).alias("l"))
    lists = lists.select(USER, F.col(f"l.{TRACK}").alias("ids"), F.col(f"l.{PREDICTION}").alias("match"), F.col("l.vector").alias("vectors"))

    def choose(batches):
        for batch in batches:
            users, tracks, scores, ranks = [], [], [], []
            for user, ids, match, vs in zip(*(batch.column(i).to_pylist() for i in range(4))):
                v = unit_rows(np.array(vs, dtype=float))
                largest = np.full(len(ids), -np.inf)
                for rank in range(1, len(ids) + 1):
                    pick = int(np.argmin(np.round(largest, TIE)))
                    users.append(user), tracks.append(ids[pick]), scores.append(match[pick]), ranks.append(rank)
                    largest = np.maximum(largest, v @ v[pick])
                    largest[[ids.index(t) for t in tracks[-rank:]]] = np.inf
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(users, batch.schema.field(0).type),
                    pa.array(tracks, batch.schema.field(1).type.value_type),
                    pa.array(scores, pa.float64()),
                    pa.array(ranks, pa.int32()),
                ],
                names=[USER, TRACK, PREDICTION, RANK],
            )

    return lists.mapInArrow(choose, f"{USER} {user_type}, {TRACK} {track_type}, {PREDICTION} double, {RANK} int")


def softmax_lists(users: DataFrame, vectors: DataFrame, train: DataFrame, k: int) -> DataFrame:
    """Best ``k`` unseen tracks by softmax over all tracks of profile-feature products."""
    return best_unseen(users, vectors, k, seen=train, score=dot_scores, softmax=True, high_track_first=True)
