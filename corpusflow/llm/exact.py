"""Exact duplicates by content sort, in DataFrame operations only.

Sampled splitters cut the space of (normalised text, id) into ranges of similar row counts, every
range is sorted, and each row is compared in full with its neighbour. Because a splitter holds the id as
well, a group of copies of any size is spread over as many ranges as its rows fill; runs that touch the
edge of a range are joined across ranges by comparing their texts, at most two per range.

Edge cases: a null text counts as empty, so null and empty texts are copies of each other. Rows with a null id
are the last choice for staying. Of rows equal in text and id exactly one stays. An empty table gives an empty
result. Other columns, whatever their names, are carried untouched by ``deduplicate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.storage import cut_lineage
from .common import lower_ascii, shuffle_width

SAMPLE_PER_SPLITTER = 16


def _splitters(keys: DataFrame, parts: int) -> list[tuple[str, int | None]]:
    """``parts - 1`` keys or fewer from an even sample of about ``16 * parts`` rows, in key order.

    Each text is cut behind the first character in which it differs from the splitter before, which
    separates the same rows; inside one text the id separates.
    """
    total = keys.count()
    if total == 0 or parts < 2:
        return []
    sample = keys.sample(fraction=min(1.0, SAMPLE_PER_SPLITTER * parts / total), seed=11)
    ranked = sample.select("_norm", "_id", F.ntile(parts).over(Window.orderBy("_norm", "_id")).alias("_tile"))
    firsts = ranked.groupBy("_tile").agg(F.min(F.struct("_norm", "_id")).alias("s")).filter("_tile > 1").orderBy("_tile")
    out: list[tuple[str, int | None]] = []
    previous = ""
    for row in firsts.select("s._norm", "s._id").toLocalIterator():
        text = row[0]
        if text == previous:
            out.append((text, row[1]))
        else:
            same = next((i for i, (a, b) in enumerate(zip(previous, text)) if a != b), min(len(previous), len(text)))
            out.append((text[: same + 1], None))
        previous = text
    return out


def _part(norm: Column, key: Column, cuts: list[tuple[str, int | None]]) -> Column:
    """Number of splitters at or below (norm, key), by two short searches: among every n-th splitter, then among n."""
    if not cuts:
        return F.lit(0)

    def literal(cut):
        text, number = cut
        # a splitter without an id stands before all rows of its text
        return F.struct(F.lit(text).alias("t"), F.lit(number).cast("bigint").alias("k"))

    def passed(cut: Column) -> Column:
        same = (norm == cut["t"]) & (cut["k"].isNull() | (key >= cut["k"]))
        return (norm > cut["t"]) | F.coalesce(same, F.lit(False))

    step = max(2, int(len(cuts) ** 0.5))
    blocks = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    coarse = F.array(*[literal(b[0]) for b in blocks])
    fine = F.array(*[F.array(*[literal(c) for c in b[1:]]) if len(b) > 1 else F.array(literal(b[0])) for b in blocks])
    lengths = F.array(*[F.lit(len(b) - 1) for b in blocks])
    block = F.size(F.filter(coarse, passed))
    inside = F.size(F.filter(F.element_at(fine, F.greatest(block, F.lit(1))), passed))
    inside = F.least(inside, F.element_at(lengths, F.greatest(block, F.lit(1))))
    return F.when(block == 0, 0).otherwise((block - 1) * step + 1 + inside)


def classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "min", parts: int | None = None) -> DataFrame:
    """One narrow row per input row: its range, its run of equal texts there, the run's size and staying id.

    ``keep`` says whether the smallest or the largest id of equal texts stays. ``_row`` is the whole
    input row as a struct; ``_text`` is set once per run that touches an edge of its range. Texts are shuffled once.
    """
    spark = docs.sparkSession
    norm = lower_ascii(F.col(text_column))
    keys = docs.select(norm.alias("_norm"), F.col(id_column).cast("bigint").alias("_id"))
    cuts = _splitters(keys, parts or 2 * shuffle_width(spark))
    # a null id stands behind all others when the smallest stays, before them when the largest does
    last = F.lit(2**63 - 1 if keep == "min" else -(2**63)).cast("bigint")
    rows = docs.select(F.struct("*").alias("_row"), norm.alias("_norm"), F.col(id_column).cast("bigint").alias("_id"))
    rows = rows.withColumn("_order", F.coalesce("_id", last))
    rows = rows.withColumn("_part", _part(F.col("_norm"), F.col("_order"), cuts).cast("int"))
    ranged = rows.repartition(shuffle_width(spark), "_part")

    sorted_part = Window.partitionBy("_part").orderBy("_norm", "_order")
    same_text = F.lag("_norm").over(sorted_part).eqNullSafe(F.col("_norm"))
    twin = same_text & F.lag("_order").over(sorted_part).eqNullSafe(F.col("_order"))
    marked = ranged.withColumns({"_new": F.when(same_text, 0).otherwise(1), "_twin": twin})
    marked = marked.withColumn("_run", F.sum("_new").over(sorted_part.rowsBetween(Window.unboundedPreceding, 0)))
    # a run is a text of a range; windows over (_part, _norm) reuse the sort above
    run = Window.partitionBy("_part", "_norm")
    best = F.min("_id") if keep == "min" else F.max("_id")
    edge = (F.col("_run") == 1) | (F.col("_run") == F.max("_run").over(Window.partitionBy("_part")))
    return marked.withColumns(
        {"_best": best.over(run), "_n": F.count(F.lit(1)).over(run), "_edge": edge}
    ).select(
        "_row",
        "_part",
        "_run",
        "_id",
        "_twin",
        "_best",
        "_n",
        F.when(F.col("_edge") & (F.col("_new") == 1), F.col("_norm")).alias("_text"),
        F.sha2("_norm", 256).alias("text_sha256"),
    )


def resolve(narrow: DataFrame, keep: str) -> DataFrame:
    """Join the runs at the edges of ranges: equal texts are neighbours, so only edge runs can share one."""
    best = F.min("_best") if keep == "min" else F.max("_best")
    runs = narrow.filter(F.col("_text").isNotNull()).select("_text", "_part", "_run", "_best", "_n")
    joined = runs.groupBy("_text").agg(best.alias("_all_best"), F.sum("_n").alias("_all_n"), F.count(F.lit(1)).alias("_pieces"))
    joined = runs.join(joined.filter("_pieces > 1"), "_text").select("_part", "_run", "_all_best", "_all_n")
    out = narrow.join(joined, ["_part", "_run"], "left")
    keep_id = F.coalesce("_all_best", "_best")
    return out.select(
        *[c for c in ("_row",) if c in narrow.columns],
        F.col("_id").alias("doc_id"),
        keep_id.alias("keep_id"),
        F.coalesce("_all_n", "_n").cast("bigint").alias("group_size"),
        (F.col("_id").eqNullSafe(keep_id) & ~F.col("_twin")).alias("kept"),
        "text_sha256",
    )


def assign(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "min", parts: int | None = None) -> DataFrame:
    """``[doc_id, keep_id, group_size, kept, text_sha256]``, one row per input row, dropped ones too."""
    narrow = classes(docs.select(id_column, text_column), id_column, text_column, keep, parts).drop("_row")
    return resolve(cut_lineage(narrow), keep)


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "min", parts: int | None = None) -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    narrow = cut_lineage(classes(docs, id_column, text_column, keep, parts))
    return resolve(narrow, keep).filter("kept").select("_row.*")
