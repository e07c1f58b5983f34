"""Dense vectors as array columns: projection, norms, routing, pooling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import dot, doubles, let, softmax, total

# a weight table up to this many cells travels with the query; beyond it the rows are joined to slabs of it
INLINE_CELLS = 262_144


def project(df: DataFrame, vec: str, weights: DataFrame, key: str, out: str = "y", inline_cells: int = INLINE_CELLS) -> DataFrame:
    """``x . W`` without bias; ``weights`` is ``[unit, w ARRAY]``, outputs are in ``unit`` order.

    The size of ``weights`` is measured. A small matrix becomes one constant of the query and
    no row moves; a large one is cut into slabs, each row meets every slab by an equi-join
    salted over 64 copies, and the slab outputs are put back in order. Rows with a null or repeated key are kept as they are.
    """
    shape = weights.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("w")).alias("d")).first()
    n, width = int(shape["n"]), int(shape["d"] or 0)
    if n * width <= inline_cells:
        matrix = weights.agg(F.array_sort(F.collect_list(F.struct("unit", doubles("w").alias("w")))).alias("m")).scalar()
        rows = df.withColumn("_m", matrix)
        outputs = let(doubles(vec), lambda x: F.transform("_m", lambda r: dot(x, r["w"])))
        return rows.withColumn(out, outputs).drop("_m")
    per_slab, salts = max(1, inline_cells // width), 64
    # slab numbers from the rank of the unit, so slabs have an exact size whatever the ids are
    from ..plans.scan import ordinal

    placed = weights.join(ordinal(weights, "unit"), "unit").withColumn("slab", F.floor(F.col("ord") / per_slab))
    slabs = placed.groupBy("slab").agg(F.array_sort(F.collect_list(F.struct("unit", doubles("w").alias("w")))).alias("m"))
    slabs = slabs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # equal rows are computed once and repeated; whole rows are the grouping key, so a null or repeated key is no matter
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_times"))
    rows = distinct.select(F.struct(*df.columns).alias("_row"), "_times", doubles(vec).alias("_x"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("_x"), F.lit(salts)).cast("int"))
    rows = rows.withColumn("slab", F.explode(F.sequence(F.lit(0), F.lit((n - 1) // per_slab)))).withColumn(
        "slab", F.col("slab").cast("bigint")
    )
    parts = rows.join(slabs, ["slab", "salt"]).select(
        "_row", "_times", F.struct("slab", F.transform("m", lambda r: dot("_x", r["w"])).alias("y")).alias("part")
    )
    whole = parts.groupBy("_row", "_times").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    whole = whole.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times"))))
    return whole.select("_row.*", F.flatten(F.transform("parts", lambda p: p["y"])).alias(out))


def rms_norm(vec: Column | str, eps: float = 1e-8, gain: Column | None = None) -> Column:
    def scale(xs: Column) -> Column:
        return F.sqrt(total(F.transform(xs, lambda x: x * x)) / F.size(xs) + F.lit(eps))

    scaled = let(doubles(vec), lambda xs: let(scale(xs), lambda s: F.transform(xs, lambda x: x / s)))
    return scaled if gain is None else F.zip_with(scaled, gain, lambda x, g: x * g)


def layer_norm(vec: Column | str, eps: float = 1e-5) -> Column:
    """Zero mean, unit population variance."""
    def scaled(centered: Column) -> Column:
        std = F.sqrt(total(F.transform(centered, lambda x: x * x)) / F.size(centered) + F.lit(eps))
        return let(std, lambda s: F.transform(centered, lambda x: x / s))

    centered = let(
        doubles(vec), lambda xs: let(total(xs) / F.size(xs), lambda m: F.transform(xs, lambda x: x - m))
    )
    return let(centered, scaled)


def centroids(df: DataFrame, vec: str, label: str) -> DataFrame:
    """Per-label mean vector ``[unit, w]``; summed per (label, dim) inside tasks first."""
    long = df.select(F.col(label).alias("unit"), F.posexplode(doubles(vec)).alias("dim", "x"))
    means = long.groupBy("unit", "dim").agg(F.avg("x").alias("x"))
    rows = means.groupBy("unit").agg(F.array_sort(F.collect_list(F.struct("dim", "x"))).alias("xs"))
    return rows.select("unit", F.transform("xs", lambda s: s["x"]).alias("w"))


def route_probs(df: DataFrame, vec: str, experts: DataFrame, key: str) -> DataFrame:
    """Softmax over experts per row (column ``probs``, in expert order)."""
    return project(df, vec, experts, key, "logits").withColumn("probs", softmax("logits")).drop("logits")


def route_topk(probs: DataFrame, key: str, k: int) -> DataFrame:
    """``[key, slot, expert, weight]``: the k most probable experts with their raw probabilities.

    ``expert`` is the 0-based position in expert order; ties go to the smaller one. Stays inside the row.
    """
    tagged = F.transform("probs", lambda p, i: F.struct((-p).alias("neg"), i.alias("expert")))
    best = F.slice(F.array_sort(tagged), 1, k)
    rows = probs.select(key, F.posexplode(best).alias("slot", "e"))
    return rows.select(key, "slot", F.col("e.expert").alias("expert"), (-F.col("e.neg")).alias("weight"))


def expert_load(routes: DataFrame, n_experts: int) -> DataFrame:
    """Rows whose first choice is each expert, zero for idle experts."""
    counts = routes.filter(F.col("slot") == 0).groupBy("expert").agg(F.count(F.lit(1)).alias("n"))
    every = routes.sparkSession.range(n_experts).select(F.col("id").cast("int").alias("expert"))
    return every.join(counts, "expert", "left").select("expert", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def balance_loss(probs: DataFrame) -> DataFrame:
    """experts * sum over experts of mean probability * first-choice share."""
    top = F.array_position("probs", F.array_max("probs")) - 1
    long = probs.select(top.alias("top"), F.posexplode("probs").alias("expert", "p"))
    per = long.groupBy("expert").agg(
        F.avg("p").alias("importance"), F.avg((F.col("top") == F.col("expert")).cast("double")).alias("load")
    )
    return per.agg((F.count(F.lit(1)) * F.sum(F.col("importance") * F.col("load"))).alias("aux_loss"))


def combine_experts(df: DataFrame, routes: DataFrame, vec: str, key: str, maps: DataFrame) -> DataFrame:
    """``[key, dim, y]``: sum over a row's slots of weight * scale[expert][dim] * x[dim] + shift.

    ``maps`` is ``[expert, scale ARRAY, shift ARRAY]``, one elementwise linear map per expert. A busy
    expert would be a hot join key, so the small map table joins by Spark's own size check.
    """
    long = df.join(routes, key).join(maps, "expert")
    terms = F.zip_with(
        F.zip_with(doubles(vec), F.col("scale"), lambda x, s: x * s), F.col("shift"), lambda a, b: a + b
    )
    weighted = F.transform(terms, lambda v: v * F.col("weight"))
    return (
        long.select(key, F.posexplode(weighted).alias("dim", "v"))
        .groupBy(key, "dim")
        .agg(F.sum("v").alias("y"))
    )


def masked_mean_pool(df: DataFrame, key: str, vec: str, keep: Column) -> DataFrame:
    """``[key, dim, mean]`` over the rows to keep; a key without any gives 0."""
    long = df.select(key, keep.alias("_keep"), F.posexplode(doubles(vec)).alias("dim", "x"))
    return long.groupBy(key, "dim").agg(
        (
            F.sum(F.when(F.col("_keep"), F.col("x")).otherwise(0.0))
            / F.greatest(F.sum(F.col("_keep").cast("int")), F.lit(1))
        ).alias("mean")
    )
