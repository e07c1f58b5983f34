"""Benchmark decontamination by greedy string tiling.

Words are hashed; a seed is a run of ``LEAST`` words of a test item (the whole item when it is shorter). Documents keep only
the stretches covered by seeds, which hold every possible tile. Seeds are joined to test items, and what the seeds of a
document cover of an item bounds what tiles can cover, so pairs below the threshold end there. For the rest,
tiling repeatedly marks the longest matching runs that do not overlap, found by Karp-Rabin hashes of windows
whose length is halved from pass to pass; tiles may come in any order. A pair is contaminated when tiles cover ``COVER``
of the item's words.

Up to ``SEED_LIMIT`` distinct seeds are sent to the tasks (8 bytes each); beyond, the seeds of documents meet those of
the test set in a join, with the same result.

Edge cases: null, empty and blank texts and items match nothing. An item with fewer words than a seed must occur whole.
Repeated rows and items that share an id are compared each by itself, and the best cover of the pair of ids counts.
Empty tables give an empty result. ``remove`` keeps the columns of its input; rows without an id count as one
document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import cut_lineage
from .common import list_rows, mix, slices, small_batches, words

LEAST = 5
# bytes of text hashed at once; the arrays for it take some twenty times as much
SLICE = 1 << 19
COVER = 0.5
SEED_LIMIT = 1 << 21
_FILTER_LOG2 = 24
TILE = "array<struct<item_start:int,doc_start:int,n:int>>"


def windows(tokens: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` tokens."""
    if len(tokens) < width:
        return np.zeros(0, np.uint64)
    out = np.full(len(tokens) - width + 1, width, np.uint64)
    for j in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + tokens[j : len(tokens) - width + 1 + j]
    return mix(out)


def items_of(benchmark: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``[item, item_id, n, width, tokens]`` of every test item that has words; ``item`` tells items with one id apart."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                tokens, at = words(part.column("_text"))
                yield pa.RecordBatch.from_arrays([part.column("item_id"), list_rows(tokens.view(np.int64), at, pa.int64())], ["item_id", "tokens"])

    kind = benchmark.schema[id_column].dataType.simpleString()
    rows = benchmark.select(F.col(id_column).alias("item_id"), F.col(text_column).alias("_text"))
    rows = rows.mapInArrow(run, f"item_id {kind}, tokens array<long>").filter(F.size("tokens") > 0)
    n = F.size("tokens")
    return rows.select(F.xxhash64("item_id", "tokens").alias("item"), "item_id", n.alias("n"), F.least(n, F.lit(LEAST)).alias("width"), "tokens")


def seeds_of(items: DataFrame) -> DataFrame:
    """``[seed, item, pos, width, n]``."""

    def run(batches):
        for batch in batches:
            for item, width, n, tokens in zip(*(batch.column(c).to_pylist() for c in ("item", "width", "n", "tokens"))):
                found = windows(np.array(tokens, np.int64).view(np.uint64), width).view(np.int64)
                count = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array(np.full(count, item)), pa.array(np.arange(count, dtype=np.int32)), pa.array(np.full(count, width, np.int32)), pa.array(np.full(count, n, np.int32))],
                    ["seed", "item", "pos", "width", "n"],
                )

    return items.mapInArrow(run, "seed long, item long, pos int, width int, n int")


def _stretches(tokens: np.ndarray, widths: list[int], is_seed) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Tokens and their places covered by seeds, and the distinct seeds; a place jumps where a stretch ends."""
    covered, found = np.zeros(len(tokens) + 1, np.int32), []
    for width in widths:
        hashes = windows(tokens, width)
        at = np.flatnonzero(is_seed(hashes))
        if len(at):
            found.append(hashes[at])
            np.add.at(covered, at, 1)
            np.add.at(covered, at + width, -1)
    if not found:
        return None
    places = np.flatnonzero(np.cumsum(covered[:-1]) > 0)
    return tokens[places], places, np.unique(np.concatenate(found))


def _member(seeds: np.ndarray):
    seeds = np.sort(seeds)
    coarse = np.zeros(1 << _FILTER_LOG2, bool)
    shift = np.uint64(64 - _FILTER_LOG2)
    coarse[seeds >> shift] = True

    def test(hashes: np.ndarray) -> np.ndarray:
        out = coarse[hashes >> shift]
        maybe = np.flatnonzero(out)
        if len(maybe):
            near = np.minimum(np.searchsorted(seeds, hashes[maybe]), len(seeds) - 1)
            out[maybe] = seeds[near] == hashes[maybe]
        return out

    return test


HIT = "tokens array<long>, places array<int>, seeds array<long>"


def _hit_rows(ids: list, kept: list, kind: pa.DataType) -> pa.RecordBatch:
    def column(k: int, of, dtype):
        offsets = np.cumsum([0, *(len(x[k]) for x in kept)])
        return list_rows(np.concatenate([np.zeros(0, of), *(x[k].astype(of, copy=False) if k == 1 else x[k].view(of) for x in kept)]), offsets, dtype)

    return pa.RecordBatch.from_arrays(
        [pa.array(ids, kind), column(0, np.int64, pa.int64()), column(1, np.int32, pa.int32()), column(2, np.int64, pa.int64())],
        ["doc_id", "tokens", "places", "seeds"],
    )


def _hits_sent(rows: DataFrame, seeds: DataFrame, widths: list[int], kind: str) -> DataFrame:
    """Stretches of every document that holds a seed, with the seeds at the tasks."""
    known = np.array([r[0] for r in seeds.select("seed").distinct().toLocalIterator()], np.int64).view(np.uint64)
    sent = rows.sparkSession.sparkContext.broadcast(known)  # SEED_LIMIT * 8 bytes at most

    def run(batches):
        test = _member(sent.value)
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                tokens, at = words(part.column("_text"))
                ids, kept = [], []
                for i in range(part.num_rows):
                    if hit := _stretches(tokens[at[i] : at[i + 1]], widths, test):
                        ids.append(part.column("doc_id")[i].as_py())
                        kept.append(hit)
                if kept:
                    yield _hit_rows(ids, kept, part.schema.field("doc_id").type)

    return rows.mapInArrow(run, f"doc_id {kind}, {HIT}")


def _hits_joined(rows: DataFrame, seeds: DataFrame, widths: list[int], kind: str) -> DataFrame:
    """The same by a join of seeds: each row's distinct windows meet the test set, then the row's text meets its seeds."""

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                tokens, at = words(part.column("_text"))
                for i in range(part.num_rows):
                    own = [windows(tokens[at[i] : at[i + 1]], w) for w in widths]
                    own = np.unique(np.concatenate(own)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([part.column("_key").slice(i, 1).take(pa.array(np.zeros(len(own), np.int64))), pa.array(own)], ["_key", "seed"])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                tokens, at = words(part.column("_text"))
                ids, kept = [], []
                for i, own in enumerate(part.column("_seeds").to_pylist()):
                    if hit := _stretches(tokens[at[i] : at[i + 1]], widths, lambda h, own=own: np.isin(h, np.array(own, np.int64).view(np.uint64))):
                        ids.append(part.column("doc_id")[i].as_py())
                        kept.append(hit)
                if kept:
                    yield _hit_rows(ids, kept, part.schema.field("doc_id").type)

    keyed = rows.withColumn("_key", F.xxhash64("doc_id", "_text"))
    found = keyed.select("_key", "_text").mapInArrow(cut, "_key long, seed long").join(seeds.select("seed").distinct(), "seed", "left_semi")
    found = found.groupBy("_key").agg(F.collect_set("seed").alias("_seeds"))  # no more than the seeds of the text
    return keyed.join(found, "_key").select("doc_id", "_text", "_seeds").mapInArrow(run, f"doc_id {kind}, {HIT}")


def _rolling(tokens: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin: hashes of all windows from one running sum of powers."""
    base = 0x5851F42D4C957F2D
    power = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(len(tokens), base, np.uint64)]))
    inverse = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(len(tokens), pow(base, -1, 1 << 64), np.uint64)]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tokens * power[:-1])])
    return (sums[width:] - sums[:-width]) * inverse[: len(sums) - width]


def tiles(item: np.ndarray, text: np.ndarray, places: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(item start, place in the document, words)``, longest first, then by place in the item and the document.

    ``places`` are the positions of ``text`` in its document; a tile never spans a jump in them.
    """
    least = max(1, min(least, len(item)))
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    joined = np.append(np.diff(places) == 1, False)  # whether the next token follows directly
    out: list[tuple[int, int, int]] = []
    width = len(item)
    while width >= least:
        blocked = False
        for n, i, j in sorted(_matches(item, text, free_item, free_text, joined, width), key=lambda m: (-m[0], m[1], m[2])):
            blocked = not (free_item[i : i + n].all() and free_text[j : j + n].all())
            if blocked:
                break  # a tile has cut this match short; what is left takes its place in the order
            free_item[i : i + n] = False
            free_text[j : j + n] = False
            out.append((i, int(places[j]), n))
        if blocked:
            continue
        width = least if least < width <= 2 * least else width // 2 if width > least else 0
    return sorted(out, key=lambda t: t[0])


def _matches(item, text, free_item, free_text, joined, width) -> list[tuple[int, int, int]]:
    """Maximal unmarked matches ``(n, i, j)`` of ``width`` words or more."""
    if len(item) < width or len(text) < width:
        return []

    def open_windows(free: np.ndarray, follow: np.ndarray | None) -> np.ndarray:
        blocked = np.concatenate([[0], np.cumsum(~free)])
        ok = blocked[width:] == blocked[:-width]
        if follow is not None and width > 1:
            gaps = np.concatenate([[0], np.cumsum(~follow)])
            ok &= gaps[width - 1 : len(free)] == gaps[: len(free) - width + 1]
        return ok

    left, right = open_windows(free_item, None), open_windows(free_text, joined)
    mine, theirs = _rolling(item, width), _rolling(text, width)
    where: dict[int, list[int]] = {}
    for i in np.flatnonzero(left):
        where.setdefault(int(mine[i]), []).append(int(i))
    found = []
    for j in np.flatnonzero(right & np.isin(theirs, mine[left])):
        j = int(j)
        for i in where[int(theirs[j])]:
            if i and j and left[i - 1] and right[j - 1] and mine[i - 1] == theirs[j - 1]:
                continue  # the match began earlier
            n = 0
            while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and free_item[i + n] and free_text[j + n] and (n == 0 or joined[j + n - 1]):
                n += 1
            if n >= width:
                found.append((n, i, j))
    return found


def contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", cover: float = COVER, seed_limit: int = SEED_LIMIT) -> DataFrame:
    """``[doc_id, item_id, n_words, covered, coverage, tiles]`` for each document and test item at or above ``cover``."""
    kind = docs.schema[id_column].dataType.simpleString()
    items = cut_lineage(items_of(benchmark, item_column, "text"))
    seeds = cut_lineage(seeds_of(items))
    widths = sorted(r[0] for r in seeds.select("width").distinct().collect())  # LEAST values at most
    small = seeds.count() <= seed_limit
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("_text"))
    hits = (_hits_sent if small else _hits_joined)(rows, seeds, widths, kind) if widths else rows.limit(0).selectExpr("doc_id", "cast(null as array<long>) tokens", "cast(null as array<int>) places", "cast(null as array<long>) seeds")
    # rows with the same stretches have the same tiles
    with small_batches(docs.sparkSession):  # the texts are read in here
        hits = cut_lineage(hits.withColumn("key", F.xxhash64("tokens", "places")))

    lookup = F.broadcast(seeds) if small else seeds
    met = hits.select("key", F.explode("seeds").alias("seed")).distinct().join(lookup, "seed")
    bound = met.groupBy("key", "item", "n", "width").agg(F.collect_set("pos").alias("pos"))
    reach = F.size(F.array_distinct(F.flatten(F.transform("pos", lambda p: F.sequence(p, p + F.col("width") - 1)))))
    pairs = bound.filter(reach >= F.col("n") * F.lit(cover)).select("key", "item")
    texts = hits.groupBy("key").agg(F.first("tokens").alias("tokens"), F.first("places").alias("places"))
    work = pairs.join(texts, "key").join(items.select("item", F.col("tokens").alias("item_tokens")).dropDuplicates(["item"]), "item")

    def run(batches):
        for batch in batches:
            out = []
            for tokens, places, item in zip(*(batch.column(c).to_pylist() for c in ("tokens", "places", "item_tokens"))):
                found = tiles(np.array(item, np.int64).view(np.uint64), np.array(tokens, np.int64).view(np.uint64), np.array(places))
                out.append([{"item_start": i, "doc_start": j, "n": n} for i, j, n in found])
            kind = pa.list_(pa.struct([("item_start", pa.int32()), ("doc_start", pa.int32()), ("n", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("item"), pa.array(out, kind)], ["key", "item", "tiles"])

    tiled = work.select("key", "item", "tokens", "places", "item_tokens").mapInArrow(run, f"key long, item long, tiles {TILE}")
    covered = F.aggregate("tiles", F.lit(0), lambda a, t: a + t["n"])
    out = tiled.withColumn("covered", covered).join(items.select("item", "item_id", "n").distinct(), "item")
    out = out.withColumn("coverage", F.col("covered") / F.col("n")).filter(F.col("coverage") >= cover)
    out = hits.select("doc_id", "key").distinct().join(out, "key")
    best = F.max(F.struct("coverage", "covered", F.col("n").alias("n_words"), "tiles")).alias("b")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.n_words", "b.covered", "b.coverage", "b.tiles")


def remove(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document holds no test item."""
    found = contaminated(docs, benchmark, id_column, text_column).select(F.col("doc_id").alias("_leak_id")).distinct()
    return docs.join(found, docs[id_column].eqNullSafe(found["_leak_id"]), "left_anti")
