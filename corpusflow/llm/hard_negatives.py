"""Hard-negative mining over an STR-packed R-tree of vectors, searched by inner product.

Sort-tile-recursive packing runs on Spark's range partitioning: slabs by the widest coordinate, tiles by the next one inside a slab (a row
number breaks ties, so equal vectors fill as many tiles as they need). A task packs its tile into leaves of ``LEAF`` rows, first by
label, then by the three widest coordinates of the tile, and writes rows and minimum bounding boxes as one row of a table. Consecutive
tiles form the nodes above, about as many nodes as a node has tiles.

For a query vector a box gives an interval of inner products, coordinate by coordinate. Queries first search the tile they
come from, which gives each a first k-th score. They then go down the tree level by level, meeting only boxes whose interval touches their score
window and reaches the k-th score (boxes strictly below it are pruned). Inside a tile every query takes leaves best first, in batches that
double, until no leaf is left that could improve its list; the rows of a leaf meet all queries that took it in one
matrix product. The best ``k`` of the tiles are ranked by a window. All pruning is exact, so recall is 1.

A query meets boxes in groups of at most about ``SLICE`` queries and one node or tile, whatever the skew; a tile has ``TILE`` rows. The
widest coordinates are found by sums over all rows; the range partitioner draws its own bounded sample.

Edge cases: rows without id or label, without vector, or with a null or non-finite component take no part. Components become
``floor(scale * x)``, saturated at the square root of 2**62 / dimension, so that inner products fit 64 bits. Shorter
vectors count as zero beyond their end; an empty vector is zero. Rows that repeat an id are rows of their own (a copy of an anchor can be its
positive, and is an anchor itself). Equal scores come by smaller id. An empty table, or one label only, gives no row. Only the
named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.storage import cut_lineage, scratch_path
from .common import shuffle_width

LEAF = 64
TILE = 8192
SLICE = 8192
CHUNK = 256
PLACE_BITS, CHUNK_BITS = 22, 12
LOWEST, HIGHEST = -(2**62), 2**62

TREE = (
    "tile long, place int, id long, label long, vec binary, ids binary, labels binary, matrix binary, starts binary, "
    "leaf_low binary, leaf_high binary, low binary, high binary, label_low long, label_high long"
)
QUERY = "query long, id long, label long, vec binary, lows array<long>, highs array<long>, floors array<long>"


# --- rows ---------------------------------------------------------------------
def prepared(rows: DataFrame, id_column: str, label: Column, vector: str, is_anchor: Column, scale: int) -> DataFrame:
    """``[id, label, vec, anchor]`` of the rows that take part, vectors as whole numbers."""
    v = F.col(vector)
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    out = rows.select(F.col(id_column).cast("bigint").alias("id"), label.cast("bigint").alias("label"), v.alias("vec"), sound.alias("_sound"), is_anchor.alias("anchor"))
    limit = float(2**31 - 1)
    whole = F.transform("vec", lambda x: F.least(F.greatest(F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"), F.lit(-limit)), F.lit(limit)).cast("int"))
    kept = out.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("_sound"))
    return kept.select("id", "label", whole.alias("vec"), F.coalesce("anchor", F.lit(False)).alias("anchor"))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int, limit: int) -> np.ndarray:
    """Lists as rows of ``dim`` numbers, zero beyond their end."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(pc.list_value_length(lists), np.int64)
    flat = np.asarray(lists.flatten(), np.int64)
    out = np.zeros((len(sizes), dim), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return np.clip(out, -limit, limit)


def spreads(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and the variance of every coordinate, widest first as coordinate numbers."""

    def sums(batches):
        total, parts = 0, np.zeros((0, 2))
        for batch in batches:
            lists = batch.column("vec")
            sizes = np.asarray(pc.list_value_length(lists), np.int64)
            total += len(sizes)
            if len(sizes) and sizes.max() > len(parts):
                parts = np.vstack([parts, np.zeros((sizes.max() - len(parts), 2))])
            m = _matrix(lists, len(parts), 2**31).astype(float)
            parts += np.stack([m.sum(axis=0), (m * m).sum(axis=0)], axis=1)
        at = np.append(-1, np.arange(len(parts)))
        first, second = np.append(float(total), parts[:, 0]), np.append(0.0, parts[:, 1])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(first), pa.array(second)], ["at", "first", "second"])

    # a row for each coordinate and task; the driver sees one for each coordinate
    found = rows.select("vec").mapInArrow(sums, "at long, first double, second double").groupBy("at").agg(F.sum("first").alias("f"), F.sum("second").alias("s"))
    held = {r["at"]: (r["f"], r["s"]) for r in found.collect()}
    n = int(held.pop(-1, (0, 0))[0])
    variance = {at: s / n - (f / n) ** 2 for at, (f, s) in held.items()} if n else {}
    return n, sorted(variance, key=lambda at: (-variance[at], at))


# --- packing ------------------------------------------------------------------
def _tiled(matrix: np.ndarray, rows: np.ndarray, coordinates: list[int]) -> list[np.ndarray]:
    """Sort-tile-recursive: leaves of at most ``LEAF`` of the given rows."""
    leaves = -(-len(rows) // LEAF)
    if leaves <= 1 or not coordinates:
        ordered = rows if not coordinates else rows[np.argsort(matrix[rows, coordinates[0]], kind="stable")]
        return [ordered[i : i + LEAF] for i in range(0, len(rows), LEAF)]
    slabs = math.ceil(leaves ** (1 / len(coordinates)))
    width = LEAF * -(-leaves // slabs)
    ordered = rows[np.argsort(matrix[rows, coordinates[0]], kind="stable")]
    return [leaf for i in range(0, len(rows), width) for leaf in _tiled(matrix, ordered[i : i + width], coordinates[1:])]


def pack(labels: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows and the first row of every leaf; labels with rows for a leaf of their own get them."""
    widest = np.argsort(-matrix.var(axis=0), kind="stable")[:3].tolist()
    by_label = np.argsort(labels, kind="stable")
    cuts = np.flatnonzero(np.diff(labels[by_label])) + 1
    groups = np.split(by_label, cuts)
    few = [g for g in groups if len(g) < LEAF]
    leaves = [leaf for g in groups if len(g) >= LEAF for leaf in _tiled(matrix, g, widest)]
    if few:
        rest = np.concatenate(few)
        leaves += [rest[i : i + LEAF] for i in range(0, len(rest), LEAF)]
    sizes = np.array([len(leaf) for leaf in leaves])
    return np.concatenate(leaves), np.cumsum(sizes) - sizes


def build(rows: DataFrame, tile: int = TILE) -> tuple[DataFrame, DataFrame, int]:
    """Tiles and anchors, read back from the written tree, and the dimension."""
    spark = rows.sparkSession
    n, widest = spreads(rows)
    dim = max(len(widest), 1)
    limit = math.isqrt(2**62 // dim)
    first, second = (widest + widest + [0, 0])[:2]
    tiles = max(1, -(-n // tile))

    def at(coordinate: int) -> Column:
        return F.coalesce(F.get("vec", F.lit(coordinate)), F.lit(0))

    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    slabs = tied.repartitionByRange(math.ceil(tiles**0.5), at(first), "_tie").withColumn("_slab", F.spark_partition_id())
    tiled = slabs.repartitionByRange(tiles, "_slab", at(second), "_tie").select("id", "label", "vec", "anchor", F.spark_partition_id().alias("part"))

    def packed(number: int, ids, labels, matrix, anchor) -> pa.RecordBatch:
        order, starts = pack(labels, matrix)
        ids, labels, matrix, anchor = ids[order], labels[order], matrix[order].astype(np.int32), anchor[order]
        low, high = np.minimum.reduceat(matrix, starts), np.maximum.reduceat(matrix, starts)
        places = np.flatnonzero(anchor)
        k = len(places)

        def column(name: str, kind, first, rest=None):
            return pa.array([first, *([None] * k if rest is None else rest)], kind)

        columns = {
            "tile": pa.array([number] * (k + 1), pa.int64()),
            "place": column("place", pa.int32(), None, places.tolist()),
            "id": column("id", pa.int64(), None, ids[places].tolist()),
            "label": column("label", pa.int64(), None, labels[places].tolist()),
            "vec": column("vec", pa.binary(), None, [matrix[p].tobytes() for p in places]),
        }
        held = {"ids": ids, "labels": labels, "matrix": matrix, "starts": starts, "leaf_low": low, "leaf_high": high}
        held |= {"low": low.min(axis=0), "high": high.max(axis=0)}
        columns |= {name: column(name, pa.binary(), value.tobytes()) for name, value in held.items()}
        columns |= {"label_low": column("", pa.int64(), int(labels.min())), "label_high": column("", pa.int64(), int(labels.max()))}
        return pa.RecordBatch.from_pydict(columns)

    def run(batches):
        held: list[tuple] = []
        count, number = 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, tile):
                part = batch.slice(at, tile)
                held.append(
                    (
                        np.asarray(part.column("id"), np.int64),
                        np.asarray(part.column("label"), np.int64),
                        _matrix(part.column("vec"), dim, limit),
                        np.asarray(part.column("anchor").to_numpy(zero_copy_only=False), bool),
                    )
                )
                first_tile = int(part.column("part")[0].as_py()) << CHUNK_BITS
                count += part.num_rows
                if count >= 2 * tile:
                    yield packed(first_tile + number, *(np.concatenate(x) for x in zip(*held)))
                    held, count, number = [], 0, number + 1
        if count:
            yield packed(first_tile + number, *(np.concatenate(x) for x in zip(*held)))

    path = scratch_path(spark, "vectors")
    tiled.mapInArrow(run, TREE).write.parquet(path)
    anchors = spark.read.parquet(path).filter("place is not null").select("tile", "place", "id", "label", "vec")
    return spark.read.parquet(path).filter("place is null").drop("place", "id", "label", "vec"), anchors, dim


# --- searching ----------------------------------------------------------------
def _fields(table: pa.Table) -> pa.Table:
    """The columns of a query, in the types they are handed on with."""
    kinds = {"binary": pa.binary(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    named = [f.split() for f in QUERY.split(", ")]
    return pa.table({name: table[name].cast(kinds[kind]) for name, kind in named})


class Queries:
    """A group of queries as arrays; numbers are floats while every inner product of the group is exact in them."""

    def __init__(self, table: pa.Table, dim: int) -> None:
        self.query = table["query"].to_numpy()
        self.label = table["label"].to_numpy()
        self.vec = np.frombuffer(b"".join(table["vec"].to_pylist()), np.int32).reshape(-1, dim)
        lows, highs, floors = (np.array(table[c].to_pylist(), np.int64) for c in ("lows", "highs", "floors"))
        self.windows = lows.shape[1] if len(self.query) else 0
        self.lows, self.highs, self.floors = lows, highs, floors

    def kind(self, *others: np.ndarray) -> type:
        peak = max((int(np.abs(o.astype(np.int64)).max()) for o in others if o.size), default=0)
        mine = int(np.abs(self.vec.astype(np.int64)).max()) if self.vec.size else 0
        return np.float64 if peak * mine * self.vec.shape[1] < 2**53 else np.int64


def intervals(vec: np.ndarray, low: np.ndarray, high: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest inner product of every query with any point of every box, added up by coordinate."""
    up, down = np.maximum(vec, 0).astype(kind), np.minimum(vec, 0).astype(kind)
    low, high = low.astype(kind).T, high.astype(kind).T
    return up @ low + down @ high, up @ high + down @ low


def useful(queries: Queries, rows: np.ndarray, least: np.ndarray, most: np.ndarray, label_low: np.ndarray, label_high: np.ndarray, same: bool) -> np.ndarray:
    """Whether a box can hold a row for one of the score windows of a query: right label, inside the window, not strictly below the k-th."""
    mine = queries.label[rows, None]
    out = (label_low <= mine) & (mine <= label_high) if same else (label_low != mine) | (label_high != mine)
    inside = np.zeros(out.shape, bool)
    bottom = np.maximum(queries.lows, queries.floors)
    for w in range(queries.windows):
        inside |= (most >= bottom[rows, w, None]) & (least <= queries.highs[rows, w, None])
    return out & inside


class Tile:
    """One tile of the tree."""

    def __init__(self, row: dict, dim: int) -> None:
        self.number = row["tile"]
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.matrix = np.frombuffer(row["matrix"], np.int32).reshape(-1, dim)
        self.starts = np.frombuffer(row["starts"], np.int64)
        self.ends = np.append(self.starts[1:], len(self.ids))
        self.low = np.frombuffer(row["leaf_low"], np.int32).reshape(-1, dim)
        self.high = np.frombuffer(row["leaf_high"], np.int32).reshape(-1, dim)
        self.label_low, self.label_high = np.minimum.reduceat(self.labels, self.starts), np.maximum.reduceat(self.labels, self.starts)


def search(tile: Tile, queries: Queries, rows: np.ndarray, k: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(list, id, score)`` of the best ``k`` rows of the tile for each list; a list is ``query row * windows + window``."""
    kind = queries.kind(tile.matrix)
    vec = queries.vec[rows].astype(kind)
    least, most = intervals(queries.vec[rows], tile.low, tile.high, kind)
    order = np.argsort(-most, axis=1, kind="stable")
    width = queries.windows
    floors = queries.floors[rows].copy()
    lows, highs = queries.lows[rows], queries.highs[rows]
    own = np.where(queries.query[rows] >> PLACE_BITS == tile.number, queries.query[rows] & ((1 << PLACE_BITS) - 1), -1)
    label = queries.label[rows]
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    here = Queries.__new__(Queries)
    here.label, here.lows, here.highs, here.windows = label, lows, highs, width
    every = np.arange(len(rows))
    at, step = 0, 1
    while at < order.shape[1]:
        here.floors = floors
        wanted = useful(here, every, least, most, tile.label_low, tile.label_high, same)
        queued = np.take_along_axis(wanted, order[:, at:], axis=1)
        if not queued.any():
            break
        who, nth = np.nonzero(queued[:, :step])
        leaf = order[who, at + nth]
        found = [held]
        by_leaf = np.argsort(leaf, kind="stable")
        for group in np.split(by_leaf, np.flatnonzero(np.diff(leaf[by_leaf])) + 1):
            if not len(group):
                continue
            number, asking = leaf[group[0]], who[group]
            begin, end = tile.starts[number], tile.ends[number]
            scores = (vec[asking] @ tile.matrix[begin:end].astype(kind).T).astype(np.int64)
            fits = (tile.labels[begin:end] == label[asking, None]) == same
            fits &= own[asking, None] != np.arange(begin, end)
            for w in range(width):
                bottom = np.maximum(lows[asking, w], floors[asking, w])
                q, r = np.nonzero(fits & (scores >= bottom[:, None]) & (scores <= highs[asking, w, None]))
                if len(q):
                    found.append((asking[q] * width + w, tile.ids[begin + r], scores[q, r]))
        lists, ids, scores = (np.concatenate(x) for x in zip(*found))
        ranked = np.lexsort((ids, -scores, lists))
        lists, ids, scores = lists[ranked], ids[ranked], scores[ranked]
        new = np.append(True, lists[1:] != lists[:-1]) if len(lists) else np.zeros(0, bool)
        place = np.arange(len(lists)) - np.maximum.accumulate(np.where(new, np.arange(len(lists)), 0))
        keep = place < k
        held = (lists[keep], ids[keep], scores[keep])
        full = lists[place == k - 1]
        floors[full // width, full % width] = np.maximum(floors[full // width, full % width], scores[place == k - 1])
        at, step = at + step, step * 2
    return held


def _searched(table: pa.Table, tiles: pa.Table, dim: int, k: int, same: bool):
    """Yields ``(queries, list, id, score)`` for a group of queries and its tile, some queries at a time."""
    queries = Queries(table, dim)
    for row in tiles.to_pylist():
        tile = Tile(row, dim)
        for at in range(0, len(queries.query), CHUNK):
            rows = np.arange(at, min(at + CHUNK, len(queries.query)))
            lists, ids, scores = search(tile, queries, rows, k, same)
            yield queries, lists + at * queries.windows, ids, scores


def _sliced(queries: DataFrame, key: Column, slices: int) -> DataFrame:
    return queries.withColumn("slice", F.pmod(F.xxhash64("query"), F.lit(slices)).cast("int")).withColumn("_key", key)


def _meet(queries: DataFrame, key: Column, boxes: DataFrame, box_key: Column, slices: int, run, schema: str) -> DataFrame:
    """Groups of queries meet the boxes of their key; a key's boxes are repeated once per slice of queries."""
    width = shuffle_width(queries.sparkSession)
    left = _sliced(queries, key, slices).repartition(width, "_key", "slice")
    parts = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    right = boxes.withColumn("_key", box_key).withColumn("slice", parts).repartition(width, "_key", "slice")
    return left.groupBy("_key", "slice").cogroup(right.groupBy("_key", "slice")).applyInArrow(run, schema)


class Tree:
    """The written tree and the searches over it."""

    def __init__(self, rows: DataFrame, tile: int = TILE, slice_rows: int = SLICE) -> None:
        self.tiles, self.anchors, self.dim = build(rows, tile)
        boxes = self.tiles.select("tile", "low", "high", "label_low", "label_high")
        count = boxes.count()
        fan = max(1, math.isqrt(max(count - 1, 0)) + 1)
        # tiles carry the number of their partition, which follows slabs; nodes are ranges of it
        most = boxes.agg(F.max("tile")).first()[0] or 0
        self.node_width = max(1, -(-((most >> CHUNK_BITS) + 1) // fan))
        self.boxes = boxes.withColumn("node", self._node(F.col("tile")))
        dim = self.dim

        def joined(table: pa.Table) -> pa.Table:
            low = np.frombuffer(b"".join(table["low"].to_pylist()), np.int32).reshape(-1, dim).min(axis=0)
            high = np.frombuffer(b"".join(table["high"].to_pylist()), np.int32).reshape(-1, dim).max(axis=0)
            ends = [pc.min(table["label_low"]).as_py()], [pc.max(table["label_high"]).as_py()]
            return pa.table(
                {"tile": table["node"].slice(0, 1), "low": [low.tobytes()], "high": [high.tobytes()], "label_low": ends[0], "label_high": ends[1]}
            )

        self.nodes = self.boxes.groupBy("node").applyInArrow(joined, "tile long, low binary, high binary, label_low long, label_high long")
        self.slices = max(1, -(-self.anchors.count() // slice_rows))

    def _node(self, tile: Column) -> Column:
        return F.floor(F.shiftright(tile, CHUNK_BITS) / self.node_width).cast("bigint")

    def seeded(self, queries: DataFrame, k: int, same: bool) -> DataFrame:
        """Queries with the k-th score of their own tile as floors."""
        dim = self.dim

        def run(table: pa.Table, tiles: pa.Table) -> pa.Table:
            table = _fields(table)
            floors = np.full((table.num_rows, len(table["lows"][0]) if table.num_rows else 0), LOWEST, np.int64)
            for queries, lists, _, scores in _searched(table, tiles, dim, k, same):
                sizes = np.bincount(lists, minlength=floors.size)
                worst = np.full(floors.size, HIGHEST)
                np.minimum.at(worst, lists, scores)
                full = sizes == k
                floors.reshape(-1)[full] = worst[full]
            return table.set_column(table.num_columns - 1, "floors", pa.array(floors.tolist(), pa.list_(pa.int64())))

        home = F.shiftright("query", PLACE_BITS)
        return _meet(queries, home, self.tiles, F.col("tile"), 1, run, QUERY)

    def found(self, queries: DataFrame, k: int, same: bool) -> DataFrame:
        """``[query, window, rank, id, score]``: the first ``k`` rows for every score window of every query."""
        dim = self.dim

        def descend(table: pa.Table, boxes: pa.Table) -> pa.Table:
            table = _fields(table)
            if not (table.num_rows and boxes.num_rows):
                return table.slice(0, 0).append_column("tile", pa.array([], pa.int64()))
            held = Queries(table, dim)
            low, high = (np.frombuffer(b"".join(boxes[c].to_pylist()), np.int32).reshape(-1, dim) for c in ("low", "high"))
            rows = np.arange(table.num_rows)
            least, most = intervals(held.vec, low, high, held.kind(low, high))
            who, box = np.nonzero(useful(held, rows, least, most, boxes["label_low"].to_numpy(), boxes["label_high"].to_numpy(), same))
            return table.take(pa.array(who)).append_column("tile", boxes["tile"].combine_chunks().take(pa.array(box)))

        def visit(table: pa.Table, tiles: pa.Table) -> pa.Table:
            out = [(np.zeros(0, np.int64),) * 4]
            if table.num_rows:
                for held, lists, ids, scores in _searched(table, tiles, dim, k, same):
                    out.append((held.query[lists // held.windows], lists % held.windows, ids, scores))
            return pa.table(dict(zip(("query", "window", "id", "score"), (np.concatenate(x) for x in zip(*out)))))

        met = f"{QUERY}, tile long"
        down = _meet(queries, F.lit(0), self.nodes, F.lit(0), self.slices, descend, met).withColumnRenamed("tile", "node")
        down = _meet(down, F.col("node"), self.boxes, F.col("node"), self.slices, descend, met)
        down = down.withColumnRenamed("tile", "_tile")
        best = _meet(down, F.col("_tile"), self.tiles, F.col("tile"), self.slices, visit, "query long, window long, id long, score long")
        ranked = Window.partitionBy("query", "window").orderBy(F.desc("score"), "id")
        return best.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    id_column: str = "vec_id",
    label: Column | None = None,
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
    scale: int = 256,
    tile: int = TILE,
    slice_rows: int = SLICE,
) -> DataFrame:
    """``[anchor_id, positive_id, rank, negative_id, positive_score, negative_score]``.

    Positives are an anchor's first ``positives`` other rows of its label. For each, the first ``negatives`` rows of other
    labels whose score lies between the two shares of the positive's score. Scores are whole inner products.
    """
    label = F.col("label") if label is None else label
    tree = Tree(prepared(rows, id_column, label, vector, is_anchor, scale), tile, slice_rows)
    query = F.shiftleft("tile", PLACE_BITS) + F.col("place")

    def one(number: int) -> Column:
        return F.array(F.lit(number).cast("bigint"))

    asked = tree.anchors.select(query.alias("query"), "id", "label", "vec", one(LOWEST).alias("lows"), one(HIGHEST).alias("highs"), one(LOWEST).alias("floors"))
    close = cut_lineage(tree.found(tree.seeded(asked, positives, True), positives, True))
    lists = close.groupBy(F.col("query").alias("_query")).agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("held"))
    # a list shorter than ``positives`` is filled with windows that hold nothing
    share = "transform(sequence(1, {n}), i -> cast({f}(get(held, i - 1).score * cast({p} as decimal(5, 0)) / 100) as bigint))"
    lows = F.expr(share.format(n=positives, f="ceil", p=least_percent))
    highs = F.expr(share.format(n=positives, f="floor", p=most_percent))
    again = asked.join(lists, F.col("query") == F.col("_query")).select(
        "query",
        "id",
        "label",
        "vec",
        F.transform(lows, lambda x: F.coalesce(x, F.lit(HIGHEST))).alias("lows"),
        F.transform(highs, lambda x: F.coalesce(x, F.lit(LOWEST))).alias("highs"),
        F.transform(lows, lambda x: F.lit(LOWEST)).alias("floors"),
    )
    far = tree.found(tree.seeded(again, negatives, False), negatives, False)
    far = far.select("query", (F.col("window") + 1).cast("int").alias("place"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    near = close.select("query", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = tree.anchors.select(query.alias("query"), F.col("id").alias("anchor_id"))
    return far.join(near, ["query", "place"]).join(named, "query").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
