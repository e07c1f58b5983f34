"""Near duplicates by circulant MinHash, banding and exact Jaccard similarity.

Shingles are mapped into ``UNIVERSE`` cells and shuffled by a first permutation; coordinate ``k`` of a signature is the
smallest value of a second permutation, shifted circularly by ``k``, over the cells of a set. All coordinates of
one cell are neighbours in one table, so a signature is a minimum over slices of that table.

1. One row per document: number of shingles, a 128-bit digest of the whole set, the signature (16 bits a coordinate).
   Documents with equal sets are one node from here on; copies are never paired.
2. Bands of signature coordinates give buckets. Each node of a bucket is compared with the bucket's smallest node, links
   are verified on the full sets, and linked nodes are merged.
3. A bucket whose nodes are all in one component needs nothing more. In the others only nodes of different components can
   still matter: their groups are compared in square blocks of bounded size, where a pair whose components have met by
   another link is skipped and every other is verified, best estimates first. No link between components is lost,
   whatever the size of a bucket, and a task returns fewer links than it has nodes.

Candidates are pairs that share a band; a pair at the threshold shares none with a chance of ``MISS`` at most. Pairs whose
signatures agree in 5.5 standard deviations fewer coordinates than the threshold asks for are not verified.

Edge cases: null, empty and blank texts have an empty set and link with nothing; fewer words than a shingle make
one shingle of the whole sequence. Rows that share a doc_id are one document. A null doc_id has no smallest id of
its own: ``component_id`` is null unless its group holds an id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import cut_lineage
from .common import mix, shingles, slices, small_batches, words
from .graph import components

WORDS = 5
COORDINATES = 256
UNIVERSE_BITS = 22
MISS = 1e-8
BLOCK = 512
SEND_ROWS = 500_000
# bytes of text hashed at once; the arrays for it take some twenty times as much
SLICE = 1 << 19

_TABLE: dict[int, np.ndarray] = {}


def band_rows(threshold: float, coordinates: int = COORDINATES) -> int:
    """The longest band for which a pair at the threshold shares no band with a chance of ``MISS`` at most."""
    return max(r for r in range(1, 17) if r == 1 or (1 - threshold**r) ** (coordinates // r) <= MISS)


def least_agreement(threshold: float, coordinates: int = COORDINATES) -> int:
    return int(coordinates * (threshold - 5.5 * (threshold * (1 - threshold) / coordinates) ** 0.5))


def _shuffled(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A permutation of the cells: odd multiplications and folded shifts are invertible."""
    mask, half = np.uint64((1 << UNIVERSE_BITS) - 1), np.uint64(UNIVERSE_BITS // 2)
    x = x.astype(np.uint64) & mask
    for factor in (a, b):
        x = (x * np.uint64(factor | 1)) & mask
        x ^= x >> half
    return x


def _second(coordinates: int) -> np.ndarray:
    """Windows over the second permutation: row ``c`` holds its values at ``c, c + 1, ...``, going round."""
    if coordinates not in _TABLE:
        size, step = 1 << UNIVERSE_BITS, 1 << 16
        ring = np.empty(size + coordinates, np.int32)
        for i in range(0, size, step):
            ring[i : i + step] = _shuffled(np.arange(i, i + step), 0x2545F491, 0x9E3779B1)
        ring[size:] = ring[:coordinates]
        _TABLE[coordinates] = np.lib.stride_tricks.sliding_window_view(ring, coordinates)
    return _TABLE[coordinates]


def signature(hashes: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """All coordinates of one set of shingle hashes; 16 bits of each are kept."""
    table = _second(coordinates)
    cells = _shuffled(hashes >> np.uint64(64 - UNIVERSE_BITS), 0x61C88647, 0xC2B2AE35)
    out = np.full(coordinates, np.iinfo(np.int32).max, np.int32)
    for i in range(0, len(cells), 4096):
        np.minimum(out, table[cells[i : i + 4096]].min(axis=0), out=out)
    return out.astype(np.uint16)


def document_sets(array: pa.Array, size: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    hashes, at = words(array)
    for i in range(len(at) - 1):
        yield np.unique(shingles(hashes[at[i] : at[i + 1]], size))


def set_digest(found: np.ndarray) -> bytes:
    """128 bits of a set."""
    halves = [np.add.reduce(mix(found ^ np.uint64(seed))) for seed in (0x1B873593, 0xCC9E2D51)]
    return np.array(halves, ">u8").tobytes()


def sketches(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = WORDS, coordinates: int = COORDINATES) -> DataFrame:
    """``[doc_id, n_shingles, node, sig]``; ``node`` is the digest of the set, null for an empty one."""
    kind = docs.schema[id_column].dataType

    def run(batches):
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                counts, nodes, sigs = [], [], []
                for found in document_sets(part.column("_text"), size):
                    counts.append(len(found))
                    if len(found):
                        nodes.append(set_digest(found))
                        sigs.append(signature(found, coordinates).tobytes())
                    else:
                        nodes.append(None)
                        sigs.append(None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()), pa.array(sigs, pa.binary())],
                    ["doc_id", "n_shingles", "node", "sig"],
                )

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("_text"))
    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, n_shingles long, node binary, sig binary")


def _matrix(column: pa.Array) -> np.ndarray:
    data, at = raw_bytes(column)
    return data.view(np.uint16).reshape(len(column), -1)


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values of a BINARY column and their offsets."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8, int(at[-1] - at[0]), int(at[0])).copy(), at - at[0]


def bands(nodes: DataFrame, rows: int) -> DataFrame:
    """``[band, node]``: one row per node and band."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = _matrix(batch.column("sig")).astype(np.uint64)
            count = sig.shape[1] // rows
            keys = np.arange(count, dtype=np.uint64)[None, :].repeat(len(sig), 0)
            for j in range(rows):
                keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + sig[:, j : count * rows : rows] + np.uint64(1))
            node = batch.column("node").take(pa.array(np.repeat(np.arange(len(sig)), count)))
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), node], ["band", "node"])

    return nodes.select("node", "sig").mapInArrow(run, "band long, node binary")


def verify(pairs: DataFrame, held: DataFrame, least: int, percent: int, size: int = WORDS) -> DataFrame:
    """The pairs ``[a, b]`` with ``100 * |A and B| >= percent * |A or B|`` on the full sets of ``held[node, sig, text]``.

    Pairs whose signatures agree in fewer than ``least`` coordinates are not looked at further.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, "ta", SLICE):
                close = (_matrix(part.column("sa")) == _matrix(part.column("sb"))).sum(axis=1) >= least
                part = part.filter(pa.array(close))
                codes = part.column("ta").dictionary_encode()  # a text is often in many pairs of a batch
                sets = list(document_sets(codes.dictionary, size))
                keep = []
                for code, other in zip(codes.indices.to_pylist(), document_sets(part.column("tb"), size)):
                    shared = len(np.intersect1d(sets[code], other, assume_unique=True))
                    keep.append(100 * shared >= percent * (len(sets[code]) + len(other) - shared))
                yield pa.RecordBatch.from_arrays([part.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], ["a", "b"])

    both = pairs.select("a", "b").join(held.toDF("a", "sa", "ta"), "a").join(held.toDF("b", "sb", "tb"), "b")
    return both.select("a", "b", "sa", "sb", "ta", "tb").mapInArrow(run, "a binary, b binary")


def _open_groups(active: DataFrame, roots: DataFrame) -> DataFrame:
    """``[group, node, root, i, j]``: what may still be linked, dealt into square blocks of two slices of ``BLOCK`` nodes.

    Buckets whose nodes have one root are done. The others tie roots into groups; a node is sent once to a group of
    up to ``BLOCK`` nodes, and to as many blocks as the group has slices beyond that, so a task is bounded for any group.
    """
    rooted = active.join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    mixed = rooted.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("band", "lo")
    members = cut_lineage(rooted.join(mixed, "band").select("node", "root", "lo").distinct())
    groups = components(members.select(F.col("lo").alias("a"), F.col("root").alias("b"))).toDF("root", "group")
    rows = members.select("node", "root").distinct().join(groups, "root")
    sizes = rows.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("cuts"))
    rows = rows.join(sizes, "group").withColumn("cut", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    return rows.select("group", "node", "root", "cut", F.least("cut", "other").alias("i"), F.greatest("cut", "other").alias("j"))


def _block_links(blocks: DataFrame, held: DataFrame, least: int, percent: int, size: int) -> DataFrame:
    """Links ``[a, b]`` between nodes of different roots: a forest of each block, so fewer links than nodes."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node")
        node, root = frame["node"].to_numpy(object), pd.factorize(frame["root"])[0]
        sig = np.stack([np.frombuffer(s, np.uint16) for s in frame["sig"]])
        sets = list(document_sets(pa.array(frame["text"], pa.string()), size))
        sizes = np.array([len(s) for s in sets])
        cut, own = frame["cut"].to_numpy(), frame["i"].iloc[0] == frame["j"].iloc[0]
        place, found = np.arange(len(node)), []
        for p in range(len(node)):
            others = np.flatnonzero((root != root[p]) & ((place > p) if own else (cut > cut[p])))
            others = others[100 * np.minimum(sizes[others], sizes[p]) >= percent * np.maximum(sizes[others], sizes[p])]
            if not len(others):
                continue
            same = (sig[others] == sig[p]).sum(axis=1)
            for k in np.argsort(-same, kind="stable"):
                q = others[k]
                if same[k] < least:
                    break
                if root[q] == root[p]:
                    continue  # met through another node
                shared = len(np.intersect1d(sets[p], sets[q], assume_unique=True))
                if 100 * shared >= percent * (sizes[p] + sizes[q] - shared):
                    found.append((node[p], node[q]))
                    root[root == root[q]] = root[p]
        return pd.DataFrame(found, columns=["a", "b"])

    rows = blocks.join(held, "node")
    return rows.groupBy("group", "i", "j").applyInPandas(run, "a binary, b binary")


def _rooted(docs: DataFrame, percent: int, id_column: str, text_column: str, size: int, coordinates: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches, nodes and ``[node, root]`` of the linked ones, all as written tables."""
    threshold = percent / 100
    least = least_agreement(threshold, coordinates)
    sketch = cut_lineage(sketches(docs, id_column, text_column, size, coordinates))
    full = sketch.filter(F.col("node").isNotNull())
    nodes = cut_lineage(full.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min("sig").alias("sig")))

    rows = bands(nodes, band_rows(threshold, coordinates))
    shared = rows.groupBy("band").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    active = cut_lineage(rows.join(shared.select("band", "pivot"), "band"))
    stars = active.filter(F.col("pivot") != F.col("node")).select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()

    # signature and text of nodes that share a bucket
    involved = active.select("node").distinct()
    holders = cut_lineage(sketch.join(involved, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id")))
    whole = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    held = _texts(whole, holders, nodes, size)

    links = cut_lineage(verify(stars, held, least, percent, size))
    roots = components(links)
    blocks = _open_groups(active.select("band", "node"), roots)
    links = links.unionByName(cut_lineage(_block_links(blocks, held, least, percent, size)))
    roots = components(links)
    return sketch, nodes, roots


def clusters(docs: DataFrame, percent: int, id_column: str = "doc_id", text_column: str = "text", size: int = WORDS, coordinates: int = COORDINATES) -> DataFrame:
    """``[doc_id, n_shingles, component_id, kept]``, one row per input row."""
    with small_batches(docs.sparkSession):  # all work in Python is done in here
        sketch, nodes, roots = _rooted(docs, percent, id_column, text_column, size, coordinates)
    grouped = nodes.select("node", "first_id").join(roots, "node")
    smallest = grouped.groupBy("root").agg(F.min("first_id").alias("least_id"))
    merged = grouped.join(smallest, "root").select("node", "least_id")
    ids = nodes.select("node", "first_id").join(merged, "node", "left").select("node", F.coalesce("least_id", "first_id").alias("component_id"))
    linked = sketch.filter(F.col("node").isNotNull()).join(ids, "node").select("doc_id", "n_shingles", "component_id")
    alone = sketch.filter(F.col("node").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def _texts(whole: DataFrame, holders: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """``[node, sig, text]`` of one document of each node; written once, as it is read several times."""

    def same_set(batches):  # rows that share a doc_id can have different texts
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                nodes = part.column("node").to_pylist()
                found = [bool(len(f)) and set_digest(f) == n for f, n in zip(document_sets(part.column("text"), size), nodes)]
                yield part.filter(pa.array(found, pa.bool_()))

    if holders.count() <= SEND_ROWS:  # 16 MB of ids; more of them meet the texts in a shuffle
        holders = F.broadcast(holders)
    held = whole.join(holders, whole["doc_id"].eqNullSafe(holders["doc_id"])).select("node", "text")
    held = held.mapInArrow(same_set, "node binary, text string")
    single = held.groupBy("node").agg(F.min("text").alias("text"))
    return cut_lineage(single.join(nodes.select("node", "sig"), "node").select("node", "sig", "text"))


def deduplicate(docs: DataFrame, percent: int = 80, id_column: str = "doc_id", text_column: str = "text", size: int = WORDS) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the document with the smallest id; documents without words stay."""
    found = clusters(docs, percent, id_column, text_column, size)
    states = found.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.max(F.col("component_id").isNull()).alias("loose"))
    dropped = cut_lineage(states.filter("not kept and not loose").select(F.col("doc_id").alias("_dropped_id")))
    if dropped.count() <= SEND_ROWS:  # then no text is shuffled
        dropped = F.broadcast(dropped)
    return docs.join(dropped, docs[id_column].eqNullSafe(dropped["_dropped_id"]), "left_anti")
