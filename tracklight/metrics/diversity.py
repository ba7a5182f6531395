"""Diversity and novelty of recommendation lists."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklight.functions.vectors import dot, euclidean, norm, sum_of, unit
from tracklight.operators.scoring import block_of, grid_partitions
from tracklight.runtime import BROADCAST_BYTES, broadcast_if_small, stage
from tracklight.schema import RANK, TRACK, USER

# A list is gathered in pieces of so many tracks; pairs of pieces meet in a join.
PIECE = 256
# Listeners of a track are held in ranges of 2 ** RANGE_BITS user ids, as many as a bitmap of Spark has; a range
# with more than DENSE listeners is a bitmap.
RANGE_BITS, DENSE = 15, 512
# Rows of lists and of train in a cell on average at most, track ids of a listener's row, and matches that a cell holds at a time.
CELL_ROWS, HEARD_BITS, CELL_MATCHES = 2_000_000, 20, 2_000_000
# Listeners of all list rows for each pair of the lists, up to which cells are counted.
MATCHES_PER_PAIR = 8


def list_distance(recs: DataFrame, vectors: DataFrame, metric: str = "cosine", vector: str = "vector") -> DataFrame:
    """``(user, distance)``: mean distance over the pairs of each list; 0 for a single track.

    Cosine needs no pairs: with unit vectors, the similarities of all pairs sum to half of the squared
    length of the vector sum less the sum of squared lengths. Euclidean distances are summed over pairs of
    pieces of a list, so a long list spreads over tasks.
    """
    if metric == "cosine":
        width = vectors.agg(F.max(F.size(vector))).first()[0] or 1
        # scaled per track, before a track is repeated for every list that holds it
        units = vectors.select(TRACK, unit(vector).alias("u"), (norm(vector) > 0).cast("int").alias("has_length"))
        sums = recs.select(USER, TRACK).join(units, TRACK).groupBy(USER).agg(
            sum_of("u", width).alias("total"), F.count(F.lit(1)).alias("n"), F.sum("has_length").alias("with_length")
        )
        pairs = F.col("n") * (F.col("n") - 1)
        similarity = F.try_divide(dot("total", "total") - F.col("with_length"), pairs)
        return sums.select(USER, F.coalesce(1.0 - similarity, F.lit(0.0)).alias("distance"))
    if metric == "euclidean":
        joined = recs.select(USER, TRACK, RANK).join(vectors.select(TRACK, F.col(vector).alias("v")), TRACK)
        among = lambda first, rest: F.aggregate(
            F.transform(first, lambda a, i: F.aggregate(rest(i), F.lit(0.0), lambda s, b: s + euclidean(a["v"], b["v"]))),
            F.lit(0.0),
            lambda s, x: s + x,
        )
        own, other = piece_pairs(joined, F.struct(RANK, "v"))
        tail = lambda i: F.slice("l", i + 2, F.greatest(F.size("l") - i - 1, F.lit(0)))
        sums = own.select(USER, "n", among(F.col("l"), tail).alias("d")).unionByName(
            other.select(USER, F.lit(0).cast("bigint").alias("n"), among(F.col("l"), lambda i: F.col("m")).alias("d"))
        )
        lists = sums.groupBy(USER).agg(F.sum("d").alias("total"), F.sum("n").alias("n"))
        pairs = F.col("n") * (F.col("n") - 1)
        return lists.select(USER, F.coalesce(F.try_divide(2.0 * F.col("total"), pairs), F.lit(0.0)).alias("distance"))
    raise ValueError(f"unknown distance: {metric}")


def mean_list_distance(recs: DataFrame, vectors: DataFrame, metric: str = "cosine", vector: str = "vector") -> DataFrame:
    return list_distance(recs, vectors, metric, vector).agg(F.avg("distance").alias("diversity"))


def novelty(recs: DataFrame, train: DataFrame, ks: list[int]) -> DataFrame:
    """Per k: mean over recommended rows of -log2(share of the train rows that the track has).

    Recommendations are counted per track before the join, so a track in every list is one row.
    """
    rows = train.agg(F.count(F.lit(1))).scalar()
    popular = train.groupBy(TRACK).agg(F.count(F.lit(1)).alias("plays"))
    times = [F.count_if(F.col(RANK) <= k).alias(f"k{k}") for k in ks]
    listed = recs.groupBy(TRACK).agg(*times).join(popular, TRACK)
    surprise = -F.log2(F.col("plays") / rows)
    by_k = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("times")) for k in ks])).alias("s")
    flat = listed.select(surprise.alias("surprise"), by_k).select("surprise", "s.*")
    return flat.groupBy("k").agg(
        F.try_divide(F.sum(F.col("surprise") * F.col("times")), F.sum("times")).alias("novelty")
    )


def piece_pairs(rows: DataFrame, item) -> tuple[DataFrame, DataFrame]:
    """Lists in pieces: ``(user, piece, n, l)`` with the sorted items of a piece and their number, and
    ``(user, l, m)`` for every two pieces of a list.

    ``rows`` has the rank of each item; ranks 1..n make pieces of ``PIECE``. Lists that fit one piece never meet
    the join.
    """
    placed = rows.withColumn("piece", F.floor((F.col(RANK) - 1) / PIECE).cast("int"))
    own = placed.groupBy(USER, "piece").agg(F.array_sort(F.collect_list(item)).alias("l"), F.count(F.lit(1)).alias("n"))
    later = own.where("piece > 0")
    earlier = later.select(USER, F.col("piece").alias("with_piece"), F.explode(F.sequence(F.lit(0), F.col("piece") - 1)).alias("piece"))
    other = earlier.join(own.select(USER, "piece", "l"), [USER, "piece"]).select(USER, F.col("with_piece").alias("piece"), "l")
    return own, other.join(later.select(USER, "piece", F.col("l").alias("m")), [USER, "piece"]).select(USER, "l", "m")


def list_pairs(recs: DataFrame, top: int, carry: list[str] | None = None) -> DataFrame:
    """Unordered pairs of tracks that share a list: ``(user, n, track_a < track_b, rank)``.

    ``n`` is the length of the list and ``rank`` the later rank of the two, i.e. the shortest list that
    holds both; columns to ``carry`` come out once per track. Lists are cut at ``top`` and formed in
    pieces, so a long one spreads over tasks.
    """
    carry = carry or []
    kept = recs.where(F.col(RANK) <= top)
    own, other = piece_pairs(kept, F.struct(TRACK, RANK, *carry))
    first = own.select(USER, F.col("n").cast("int").alias("n"), "l", F.posexplode("l").alias("i", "a"))
    tail = F.slice("l", F.col("i") + 2, F.greatest(F.size("l") - F.col("i") - 1, F.lit(0)))
    pairs = first.select(USER, "n", "a", F.explode(tail).alias("b"))
    if top > PIECE:
        pairs = pairs.drop("n").unionByName(other.select(USER, "m", F.explode("l").alias("a")).select(USER, "a", F.explode("m").alias("b")))
        swap = F.col(f"a.{TRACK}") > F.col(f"b.{TRACK}")
        pairs = pairs.select(USER, F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b"))
        pairs = pairs.join(kept.groupBy(USER).agg(F.count(F.lit(1)).cast("int").alias("n")), USER)
    return pairs.select(
        USER,
        "n",
        *[F.col(f"{side}.{c}").alias(f"{name}_{side}") for c, name in [(TRACK, "track"), *zip(carry, carry)] for side in ("a", "b")],
        F.greatest(f"a.{RANK}", f"b.{RANK}").alias(RANK),
    )


def listener_pieces(train: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Who heard a track, in pieces of neighbouring user ids: ``(track, range, ids)`` with at most ``DENSE`` ids, and
    ``(track, range, bits)`` with a bitmap of the range where a piece has more (None if there is none)."""
    heard = train.select(TRACK, F.shiftright(F.col(USER).cast("bigint"), RANGE_BITS).alias("range"), F.pmod(F.col(USER).cast("bigint"), F.lit(1 << RANGE_BITS)).alias("place"))
    sizes = stage(heard.groupBy(TRACK, "range").agg(F.count(F.lit(1)).alias("n")), "pieces")
    dense = sizes.where(F.col("n") > DENSE).select(TRACK, "range")
    n_dense = dense.count()
    if not n_dense:
        return heard.groupBy(TRACK, "range").agg(F.collect_list(F.col("place").cast("int")).alias("ids")), None
    dense = broadcast_if_small(dense, n_dense, 24)
    listed = heard.join(dense, [TRACK, "range"], "left_anti").groupBy(TRACK, "range").agg(F.collect_list(F.col("place").cast("int")).alias("ids"))
    bits = heard.join(dense, [TRACK, "range"], "left_semi").groupBy(TRACK, "range").agg(F.bitmap_construct_agg("place").alias("bits"))
    return listed, bits


def common_in_bitmaps(batches):
    """Sizes of intersections of pieces of which one or both are bitmaps; the weights are passed on."""
    for batch in batches:
        names = batch.schema.names
        bits = {side: batch.column(f"bits_{side}") for side in ("a", "b")}
        ids = {side: batch.column(f"ids_{side}") for side in ("a", "b")}
        common = np.zeros(batch.num_rows, dtype=np.int64)
        is_bitmap = {side: bits[side].is_valid().to_numpy(zero_copy_only=False) for side in ("a", "b")}
        # row by row over fixed-size pieces: 4,096 bytes or DENSE ids at most
        for row in range(batch.num_rows):
            if is_bitmap["a"][row] and is_bitmap["b"][row]:
                one, two = (np.frombuffer(bits[side][row].as_buffer(), dtype=np.uint64) for side in ("a", "b"))
                common[row] = int(np.bitwise_count(one & two).sum())
            else:
                side, other = ("a", "b") if is_bitmap["a"][row] else ("b", "a")
                bitmap = np.frombuffer(bits[side][row].as_buffer(), dtype=np.uint8)
                at = ids[other][row].values.to_numpy()
                common[row] = int((bitmap[at >> 3] >> (at & 7) & 1).sum())
        kept = [n for n in names if n.startswith("k")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(common)], [*kept, "common"])


def count_in_pieces(pairs: DataFrame, train: DataFrame, names: list[str]) -> DataFrame:
    """``names`` of the pairs (track, other, names) and ``common``, their listeners in common, one row per range of user ids."""
    listed, bitmaps = listener_pieces(train)
    pieces = listed.withColumn("bits", F.lit(None).cast("binary"))
    if bitmaps is not None:
        pieces = pieces.unionByName(bitmaps.withColumn("ids", F.lit(None).cast("array<int>")))
    pieces = stage(pieces, "listeners")
    held = pieces.agg(F.sum(F.coalesce(F.size("ids") * 4, F.lit(0)) + F.coalesce(F.octet_length("bits"), F.lit(0)) + 64)).first()[0] or 0
    # Spark's own estimate counts the compressed file without its bitmaps, far below what the driver would hold
    small = lambda df: F.broadcast(df) if held <= BROADCAST_BYTES else df.hint("merge")
    of_rarer = pairs.join(small(pieces.select(TRACK, "range", F.col("ids").alias("ids_a"), F.col("bits").alias("bits_a"))), TRACK)
    met = of_rarer.join(small(pieces.select(F.col(TRACK).alias("other"), "range", F.col("ids").alias("ids_b"), F.col("bits").alias("bits_b"))), ["other", "range"])
    lists_only = F.col("bits_a").isNull() & F.col("bits_b").isNull()
    counted = met.where(lists_only).select(*names, F.size(F.array_intersect("ids_a", "ids_b")).cast("bigint").alias("common"))
    if bitmaps is not None:
        schema = ", ".join(f"{name} double" for name in names) + ", common bigint"
        return counted.unionByName(met.where(~lists_only).select(*names, "ids_a", "bits_a", "ids_b", "bits_b").mapInArrow(common_in_bitmaps, schema))
    return counted


def similar_in_cell(lists: pa.Table, heard: pa.Table, ks: list[int]) -> np.ndarray:
    """Per k, the weighted similarities of the pairs of ``lists`` (tracks, ranks, listeners, n) from the listeners ``heard`` (user, tracks) of a cell.

    With x = 1 / sqrt(listeners), the pairs of a list that a listener heard both of add up to half of (sum of x) ** 2 less the sum of x ** 2.
    """
    flat = lambda table, name: table[name].combine_chunks().flatten().to_numpy()
    sizes = lambda table, name: pa.compute.list_value_length(table[name]).to_numpy()
    ids, listener = np.unique(heard[USER].to_numpy(), return_inverse=True)
    track = flat(heard, "tracks")
    by_track = np.argsort(track, kind="stable")
    track, listener = track[by_track], np.repeat(listener, sizes(heard, "tracks"))[by_track]

    wanted, rank, popular = (flat(lists, name) for name in ("tracks", "ranks", "listeners"))
    x = np.divide(1.0, np.sqrt(popular), out=np.zeros(len(popular)), where=popular > 0)
    row = np.repeat(np.arange(len(lists)), sizes(lists, "tracks"))
    low, high = np.searchsorted(track, wanted, side="left"), np.searchsorted(track, wanted, side="right")
    matches = high - low
    ends = np.cumsum(np.bincount(row, weights=matches, minlength=len(lists)).astype(np.int64))  # by list
    first = np.searchsorted(row, np.arange(len(lists) + 1))
    found = np.zeros((len(ks), len(lists)))
    at, done = 0, 0
    while at < len(lists):
        to = max(at + 1, int(np.searchsorted(ends, done + CELL_MATCHES, side="right")))
        cut = slice(first[at], first[to])
        if ends[to - 1] - done > CELL_MATCHES:  # a single list that many listeners heard parts of
            for i, k in enumerate(ks):
                total, squares = np.zeros(len(ids)), np.zeros(len(ids))
                for e in range(cut.start, cut.stop):
                    if rank[e] <= k:
                        np.add.at(total, listener[low[e] : high[e]], x[e])
                        np.add.at(squares, listener[low[e] : high[e]], x[e] * x[e])
                found[i, at] = ((total * total - squares) / 2).sum()
        else:
            n = matches[cut]
            entry = np.repeat(np.arange(cut.start, cut.stop), n)
            place = np.arange(len(entry)) - np.repeat(np.cumsum(n) - n, n) + low[entry]
            key = (row[entry] - at) * np.int64(len(ids)) + listener[place]
            order = np.argsort(key, kind="stable")
            key, entry = key[order], entry[order]
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, dtype=np.int64)
            several = np.diff(np.append(starts, len(key))) > 1  # one track alone makes no pair
            entry = entry[np.repeat(several, np.diff(np.append(starts, len(key))))]
            length = np.diff(np.append(starts, len(key)))[several]
            if len(length):
                begin = np.cumsum(length) - length
                owner = row[entry[begin]]
                for i, k in enumerate(ks):
                    own = np.where(rank[entry] <= k, x[entry], 0.0)
                    total, squares = np.add.reduceat(own, begin), np.add.reduceat(own * own, begin)
                    found[i] += np.bincount(owner, weights=(total * total - squares) / 2, minlength=len(lists))
        at, done = to, int(ends[to - 1])
    n = lists["n"].to_numpy()
    weight = [np.divide(2.0, np.minimum(n, k) * (np.minimum(n, k) - 1.0), out=np.zeros(len(n)), where=np.minimum(n, k) > 1) for k in ks]
    return (found * np.array(weight)).sum(axis=1)


def count_in_cells(sized: DataFrame, train: DataFrame, ks: list[int]) -> DataFrame:
    """One row per cell with the weighted similarities of all pairs of its lists, over its listeners, as ``k{k}``.

    ``sized`` are list rows with the ``listeners`` of their track. Lists and listeners are dealt into blocks; a cell of two blocks finds
    who heard two tracks of a list. What is shuffled are the rows of lists and of train, once per block of the other side, in arrays.
    """
    spark = train.sparkSession
    least = math.ceil(math.sqrt(2 * spark.sparkContext.defaultParallelism))
    list_blocks, heard_blocks = (max(least, math.ceil(df.count() / CELL_ROWS)) for df in (sized, train))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    items = F.sort_array(F.collect_list(F.struct(RANK, TRACK, "listeners")))
    lists = sized.groupBy(USER).agg(items.alias("l"), F.count(F.lit(1)).alias("n")).select(
        block_of(USER, list_blocks).alias("a"),
        F.col(USER).cast("bigint").alias(USER),
        F.col(f"l.{TRACK}").alias("tracks"), F.col(f"l.{RANK}").cast("array<int>").alias("ranks"), F.col("l.listeners").cast("array<bigint>").alias("listeners"), "n",
    )
    # a very active listener has several rows
    heard = train.groupBy(USER, F.shiftright(F.col(TRACK).cast("bigint"), HEARD_BITS)).agg(F.collect_list(TRACK).alias("tracks"))
    heard = heard.select(block_of(USER, heard_blocks).alias("b"), F.col(USER).cast("bigint").alias(USER), "tracks")
    cells = list_blocks * heard_blocks
    partitions = grid_partitions(spark, cells)
    left = lists.withColumn("b", every(heard_blocks)).repartition(partitions, "a", "b")
    right = heard.withColumn("a", every(list_blocks)).repartition(partitions, "a", "b")
    names = [f"k{k}" for k in ks]

    def cell(list_rows: pa.Table, heard_rows: pa.Table) -> pa.Table:
        both = len(list_rows) and len(heard_rows)
        found = similar_in_cell(list_rows, heard_rows, ks) if both else np.zeros(len(ks))
        return pa.table({name: pa.array([value]) for name, value in zip(names, found)})

    return left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInArrow(cell, ", ".join(f"{name} double" for name in names))


def collaborative_diversity(recs: DataFrame, train: DataFrame, ks: list[int]) -> DataFrame:
    """Per k: 1 less the mean over users of the mean co-listening cosine of the pairs in their list.

    ``train`` has one row per user and track. The cosine n_ab / sqrt(n_a n_b) of a pair needs the number of users who heard
    both, and occurs once with the sum of its weights 1 / (pairs of the list). Where ``train`` may be broadcast, the listeners
    of the rarer track are looked up among those of the other. Beyond, where lists have few listeners for their pairs, no pair is
    formed at all (``count_in_cells``). Where many lists share their tracks and so their pairs, a pair meets the listeners of its two
    tracks range by range of user ids: first the pieces of its rarer track, then the other's pieces of the same ranges. A row then
    stays one row through both joins, whatever a track's listeners are, so a track in every list spreads over
    ranges and splits as any skewed join; short pieces are lists, long ones bitmaps.
    """
    top = max(ks)
    recs = recs.where(F.col(RANK) <= top).select(USER, TRACK, RANK)
    listeners = train.groupBy(TRACK).agg(F.count(F.lit(1)).alias("listeners"))
    sized = recs.join(listeners, TRACK, "left").na.fill(0, ["listeners"])
    users = recs.where(F.col(RANK) == 2).agg(F.count(F.lit(1))).scalar()
    by_k = F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("similar")) for k in ks]))
    rows = train.count()
    if rows * 24 > BROADCAST_BYTES and top <= PIECE:
        sized = stage(sized, "sized")
        pairs = sized.groupBy(USER).agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.col("n") * (F.col("n") - 1)) / 2).first()[0] or 0
        heard = sized.agg(F.sum("listeners")).first()[0] or 0  # of all list rows: what cells would match
        if heard <= MATCHES_PER_PAIR * pairs:
            totals = count_in_cells(sized, train, ks).agg(*[F.coalesce(F.sum(f"k{k}"), F.lit(0.0)).alias(f"k{k}") for k in ks])
            return totals.select(by_k).select("k", (1.0 - F.try_divide("similar", users)).alias("diversity"))
    weight = lambda k: F.when(
        F.col(RANK) <= k,
        2.0 / (F.least(F.col("n"), F.lit(k)) * (F.least(F.col("n"), F.lit(k)) - 1)),
    ).otherwise(0.0)
    ends = ["track_a", "track_b", "listeners_a", "listeners_b"]
    weighted = list_pairs(sized, top, ["listeners"]).groupBy(*ends).agg(*[F.sum(weight(k)).alias(f"k{k}") for k in ks])

    a_is_rarer = F.col("listeners_a") <= F.col("listeners_b")
    length = F.sqrt(F.col("listeners_a").cast("double") * F.col("listeners_b"))
    names = [f"k{k}" for k in ks]
    sided = weighted.where((F.col("listeners_a") > 0) & (F.col("listeners_b") > 0)).select(
        F.when(a_is_rarer, F.col("track_a")).otherwise(F.col("track_b")).alias(TRACK),
        F.when(a_is_rarer, F.col("track_b")).otherwise(F.col("track_a")).alias("other"),
        *[(F.col(name) / length).alias(name) for name in names],
    )
    if rows * 24 <= BROADCAST_BYTES:  # who heard what fits every task: listeners are looked up where the pairs are
        heard = F.broadcast(train.select(USER, TRACK))
        of_rarer = sided.join(heard, TRACK).drop(TRACK).withColumnRenamed("other", TRACK)
        counted = of_rarer.join(heard, [TRACK, USER], "left_semi").select(*names, F.lit(1).cast("bigint").alias("common"))
    else:
        counted = count_in_pieces(sided, train, names)
    totals = counted.agg(*[F.coalesce(F.sum(F.col(name) * F.col("common")), F.lit(0.0)).alias(name) for name in names])
    return totals.select(by_k).select("k", (1.0 - F.try_divide("similar", users)).alias("diversity"))
