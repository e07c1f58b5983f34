"""Count-based next-token model held in tables: fit, distributions, scoring, sampling."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as tx
from ..functions.arrays import EOS_ID, let, tail
from ..plans.skew import attach
from ..plans.storage import cut_lineage

BYTE_VOCAB = 256
# a transition table is joined by broadcast only if vocab**order is at most this
BOUNDED_ROWS = 65_536
# ids that a task counts at once
SLICE = 1 << 20


@dataclass(frozen=True)
class NgramModel:
    """Counts ``[ctx, next, n]`` with add-``alpha`` smoothing over ``vocab`` tokens."""

    counts: DataFrame
    order: int = 2
    vocab: int = BYTE_VOCAB
    alpha: float = 1.0

    @property
    def bounded(self) -> bool:
        """All (ctx, next) pairs fit a broadcast whatever the corpus size."""
        return self.vocab**self.order <= BOUNDED_ROWS

    def totals(self) -> DataFrame:
        return self.counts.groupBy("ctx").agg(F.sum("n").alias("total"))

    def logp(self, n: Column, total: Column) -> Column:
        n = F.coalesce(n, F.lit(0)).cast("double")
        total = F.coalesce(total, F.lit(0)).cast("double")
        return F.ln((n + self.alpha) / (total + self.alpha * self.vocab))

    def seen(self) -> DataFrame:
        """``[ctx, next, n, logp]`` for observed pairs; a context has at most ``vocab`` of them."""
        total = F.sum("n").over(Window.partitionBy("ctx"))
        return self.counts.select("ctx", "next", "n", self.logp(F.col("n"), total).alias("logp"))

    def dense(self, logp: str = "logp") -> DataFrame:
        """``[ctx, next, logp]`` for every pair of a bounded model (at most ``BOUNDED_ROWS`` rows).

        The context total is a window over its ``vocab`` rows, so the counts are read once.
        """
        if not self.bounded:
            raise ValueError("a dense table needs vocab ** order <= %d" % BOUNDED_ROWS)
        filled = pair_grid(self.counts.sparkSession, self.vocab, self.order).join(self.counts, ["ctx", "next"], "left")
        total = F.sum("n").over(Window.partitionBy("ctx"))
        return filled.select("ctx", "next", self.logp(F.col("n"), total).alias(logp))


def pair_grid(spark: SparkSession, vocab: int = BYTE_VOCAB, order: int = 2) -> DataFrame:
    """Every ``[ctx, next]`` of a bounded model."""
    codes = spark.range(vocab**order)
    return codes.select(F.expr(f"id div {vocab}").alias("ctx"), (F.col("id") % vocab).cast("int").alias("next"))


def transitions(ids: Column | str, order: int = 2, vocab: int = BYTE_VOCAB) -> Column:
    """Array of ``(pos, ctx, next)``; ``ctx`` packs the previous ``order - 1`` tokens in base ``vocab``."""
    ids = tx.as_col(ids)
    if vocab**order >= 2**63:
        raise ValueError("vocab ** order must fit a BIGINT")

    def step(i: Column) -> Column:
        ctx = F.lit(0).cast("bigint")
        for back in range(order - 1, 0, -1):
            ctx = ctx * vocab + F.get(ids, i - back).cast("bigint")
        return F.struct(i.alias("pos"), ctx.alias("ctx"), F.get(ids, i).alias("next"))

    spots = F.sequence(F.lit(order - 1), F.size(ids) - 1)
    return F.when(F.size(ids) >= order, F.transform(spots, step))


def pair_codes(ids: Column | str, order: int = 2, vocab: int = BYTE_VOCAB) -> Column:
    """Array of ``ctx * vocab + next``: one BIGINT per transition, for counting."""
    ids = tx.as_col(ids)

    def code(i: Column) -> Column:
        out = F.get(ids, i - (order - 1)).cast("bigint")
        for back in range(order - 2, -1, -1):
            out = out * vocab + F.get(ids, i - back).cast("bigint")
        return out

    spots = F.sequence(F.lit(order - 1), F.size(ids) - 1)
    return F.when(F.size(ids) >= order, F.transform(spots, code))


def _is_text(column: pa.Array) -> bool:
    return pa.types.is_string(column.type) or pa.types.is_large_string(column.type)


def _sizes(column: pa.Array) -> np.ndarray:
    length = pc.binary_length if _is_text(column) else pc.list_value_length
    return np.asarray(pc.fill_null(length(column), 0), np.int64)


def _text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end and the offsets of each; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets else np.zeros(1, np.int64)
    size = int(at[-1] - at[0])
    return np.frombuffer(data, np.uint8, size, int(at[0])) if size else np.zeros(0, np.uint8), at - at[0]


def _gram_counter(order: int, vocab: int, keys: list[str]):
    """Counts of a task's transitions from ``_ids`` (lists of ids, or texts, whose UTF-8 bytes are the ids).

    A batch is worked off in slices of about ``SLICE`` ids, so memory does not grow with the rows of a task. Without
    keys a task adds up all pairs of a bounded model in one array; otherwise each slice gives its distinct codes.
    """
    size = vocab**order
    add_up = not keys and size <= BOUNDED_ROWS

    def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if _is_text(column):
            return _text_bytes(column)
        return np.asarray(pc.fill_null(column.flatten(), -1), np.int64), np.append(0, np.cumsum(_sizes(column)))

    def counted(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row that stands for the key, code and count of each distinct (key, code)."""
        none = np.zeros(0, np.int64)
        ids, at = tokens(batch.column("_ids"))
        spots = len(ids) - order + 1
        if spots < 1:
            return none, none, none
        codes, known = np.zeros(spots, np.int64), np.ones(spots, bool)
        for k in range(order):
            here = ids[k : k + spots]
            codes = codes * vocab + here
            if ids.dtype != np.uint8 or vocab < 256:
                known &= (here >= 0) & (here < vocab)
        # the last tokens of a text and the first of the next are no transition
        stops = np.repeat(at[1:].astype(np.int32), np.diff(at))[:spots]
        known &= np.arange(order, order + spots, dtype=np.int32) <= stops
        firsts, group = np.zeros(1, np.int64), None
        if keys:
            rows = pa.table({**{k: batch.column(k) for k in keys}, "_row": pa.array(np.arange(len(batch)))})
            found = rows.group_by(keys).aggregate([("_row", "min"), ("_row", "list")])
            firsts = np.asarray(found.column("_row_min"), np.int64)
            lists = found.column("_row_list").combine_chunks()
            of_row = np.empty(len(batch), np.int64)
            of_row[np.asarray(lists.flatten())] = np.repeat(np.arange(len(firsts)), np.asarray(pc.list_value_length(lists)))
            group = np.repeat(of_row, np.diff(at))[:spots][known]
        codes = codes[known]
        if len(firsts) * size <= SLICE:
            sums = np.bincount(codes if group is None else group * size + codes, minlength=size)
            places = np.flatnonzero(sums)
            return firsts[places // size], places % size, sums[places]
        distinct, code = np.unique(codes, return_inverse=True)
        pairs, sums = np.unique(code if group is None else group * max(len(distinct), 1) + code, return_counts=True)
        return firsts[pairs // max(len(distinct), 1)], distinct[pairs % max(len(distinct), 1)], sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size if add_up else 0, np.int64)
        for batch in batches:
            for part in _id_slices(batch):
                rows, codes, sums = counted(part)
                if add_up:
                    total[codes] += sums
                else:
                    held = [part.column(k).take(pa.array(rows)) for k in keys]
                    yield pa.RecordBatch.from_arrays([*held, pa.array(codes, pa.int64()), pa.array(sums, pa.int64())], [*keys, "_code", "n"])
        if add_up:
            found = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["_code", "n"])

    return run


def _id_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Row ranges of about ``SLICE`` ids; one longer text comes with at most so many more."""
    ends = np.cumsum(_sizes(batch.column("_ids")))
    cuts = np.flatnonzero(np.diff(ends // SLICE, prepend=0))
    for begin, end in zip([0, *cuts], [*cuts, len(batch)]):
        if end > begin:
            yield batch.slice(begin, end - begin)


def count_transitions(df: DataFrame, *keys: str, order: int = 2, vocab: int = BYTE_VOCAB, ids: str = "ids") -> DataFrame:
    """``[keys.., ctx, next, n]`` from an ``ids`` column; counted inside each task before the shuffle.

    A string column stands for the ids of its UTF-8 bytes, which are then never made. Transitions with a null id or one
    outside the vocabulary do not count.
    """
    if vocab**order >= 2**63:
        raise ValueError("vocab ** order must fit a BIGINT")
    rows = df.select(*keys, F.col(ids).alias("_ids"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    counted = rows.mapInArrow(_gram_counter(order, vocab, rows.columns[:-1]), f"{kinds}_code long, n long")
    counted = counted.groupBy(*keys, "_code").agg(F.sum("n").alias("n"))
    return counted.select(*keys, F.expr(f"_code div {vocab}").alias("ctx"), (F.col("_code") % vocab).cast("int").alias("next"), "n")


def fit_ngram(df: DataFrame, order: int = 2, alpha: float = 1.0, vocab: int = BYTE_VOCAB, ids: str = "ids") -> NgramModel:
    """Counts of a corpus with an ``ids`` column, a string standing for its bytes. Those of an unbounded model are written once,
    because scoring reads them several times."""
    counts = count_transitions(df, order=order, vocab=vocab, ids=ids)
    if vocab**order > BOUNDED_ROWS:
        counts = cut_lineage(counts)
    return NgramModel(counts, order, vocab, alpha)


def score_transitions(rows: DataFrame, model: NgramModel, out: str = "logp", salt_by: tuple[str, ...] = ()) -> DataFrame:
    """Add ``log p(next | ctx)`` to rows with ``ctx`` and ``next``.

    Rows whose context or token is null or outside the vocabulary (an ignored label) are left out. A bounded model
    is broadcast. A larger one is an equi-join on (ctx, next) where the model's
    own counts say which pairs are hot; unseen pairs take the smoothed value of their context.
    """
    rows = rows.filter(F.col("next").between(0, model.vocab - 1) & F.col("ctx").between(0, model.vocab ** (model.order - 1) - 1))
    if model.bounded:
        return rows.join(F.broadcast(model.dense(out)), ["ctx", "next"])
    salt = list(salt_by) or rows.columns
    # the context's own row goes first: it carries the floor for unseen continuations
    totals = model.totals()
    known = attach(rows, totals, ["ctx"], "total", salt, how="left")
    counts = model.counts
    scored = attach(known, counts, ["ctx", "next"], "n", salt, how="left", written=True)
    return scored.withColumn(out, model.logp(F.col("n"), F.col("total"))).drop("n", "total")


def token_logprobs(df: DataFrame, model: NgramModel, *keep: str, out: str = "logp") -> DataFrame:
    """``[keep.., pos, token, logp]`` for every position that has a full context."""
    rows = df.select(*keep, F.explode(transitions("ids", model.order, model.vocab)).alias("t"))
    rows = rows.select(*keep, F.col("t.pos").alias("pos"), F.col("t.ctx").alias("ctx"), F.col("t.next").alias("next"))
    return score_transitions(rows, model, out, (*keep, "pos")).select(
        *keep, "pos", F.col("next").alias("token"), out
    )


def cross_entropy(df: DataFrame, model: NgramModel, *keys: str, ids: str = "ids") -> DataFrame:
    """Mean negative log-likelihood, perplexity and token count, per ``keys``.

    Transitions are counted first, so the model is joined to distinct transitions, not to tokens.
    """
    counted = count_transitions(df, *keys, order=model.order, vocab=model.vocab, ids=ids).withColumnRenamed("n", "m")
    scored = score_transitions(counted, model, salt_by=("ctx", "next", *keys))
    nll = -F.sum(F.col("m") * F.col("logp")) / F.sum("m")
    return scored.groupBy(*keys).agg(nll.alias("nll"), F.exp(nll).alias("ppl"), F.sum("m").alias("n_tokens"))


def masked_cross_entropy(logps: DataFrame, logp: str = "logp", label: str = "label", ignore: int = -100) -> DataFrame:
    """Mean of ``-logp`` over positions whose label is not the ignored one."""
    kept = logps.filter(F.col(label) != ignore)
    return kept.agg((-F.avg(logp)).alias("loss"), F.count(F.lit(1)).alias("n"))


def estimate_loss(block_losses: DataFrame, split: str, batch: str, loss: str) -> DataFrame:
    """Mean of batch means per split."""
    per_batch = block_losses.groupBy(split, batch).agg(F.avg(loss).alias("loss"))
    return per_batch.groupBy(split).agg(F.avg("loss").alias("loss"), F.count(F.lit(1)).alias("n_batches"))


def sequence_logps(tokens: DataFrame, seq: str, mask: str, logp: str, out: str = "seq_logp") -> DataFrame:
    """Sum of log-probs over response tokens; a sequence without any gives 0."""
    return tokens.groupBy(seq).agg(F.sum(F.when(F.col(mask), F.col(logp)).otherwise(0.0)).alias(out))


# --- next-token distributions -------------------------------------------------
# Windows here run inside one context, which has at most ``vocab`` rows.
def next_token_dist(logits: DataFrame, temperature: float = 1.0, logit: str = "logit") -> DataFrame:
    """``[ctx, next, logit, p]``: temperature-scaled, max-shifted softmax per context."""
    ctx = Window.partitionBy("ctx")
    scaled = logits.withColumn("logit", F.col(logit) / float(max(temperature, 1e-6)))
    shifted = scaled.withColumn("_e", F.exp(F.col("logit") - F.max("logit").over(ctx)))
    return shifted.withColumn("p", F.col("_e") / F.sum("_e").over(ctx)).drop("_e")


def _renormalise(dist: DataFrame) -> DataFrame:
    return dist.withColumn("p", F.col("p") / F.sum("p").over(Window.partitionBy("ctx")))


def top_k(dist: DataFrame, k: int) -> DataFrame:
    """Keep logits no smaller than the k-th largest; ties at the k-th stay."""
    ranked = dist.withColumn("_r", F.rank().over(Window.partitionBy("ctx").orderBy(F.desc("logit"))))
    return _renormalise(ranked.filter(F.col("_r") <= k).drop("_r"))


def top_p(dist: DataFrame, p: float) -> DataFrame:
    """Keep the first token and those whose inclusive cumulative probability is at most ``p``."""
    if not 0.0 < p < 1.0:
        return dist
    order = Window.partitionBy("ctx").orderBy(F.desc("logit"), "next")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = dist.withColumn("_c", F.sum("p").over(running)).withColumn("_r", F.row_number().over(order))
    return _renormalise(ranked.filter((F.col("_r") == 1) | (F.col("_c") <= p)).drop("_c", "_r"))


def cumulative(dist: DataFrame) -> DataFrame:
    """``[ctx, next, lo, hi]``: each token's slice of [0, 1) in token order; the last reaches 1."""
    order = Window.partitionBy("ctx").orderBy("next")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.lead("next").over(order).isNull()
    rows = dist.withColumn("hi", F.when(last, F.lit(1.0)).otherwise(F.sum("p").over(running)))
    return rows.select("ctx", "next", F.coalesce(F.lag("hi").over(order), F.lit(0.0)).alias("lo"), "hi")


def greedy_next(dist: DataFrame) -> DataFrame:
    """Most probable token per context, smallest id on ties: ``[ctx, next]``."""
    best = F.max_by("next", F.struct("logit", -F.col("next")))
    return dist.groupBy("ctx").agg(best.alias("next"))


def sample_next(dist: DataFrame, seed: int) -> DataFrame:
    """One token per context, drawn in proportion to ``p`` with a reproducible uniform."""
    slices = cumulative(dist).withColumn("u", tx.uniform(F.lit(seed), "ctx"))
    return slices.filter((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi"))).select("ctx", "next")


# --- generation ---------------------------------------------------------------
CUT = "array<struct<lo:double,hi:double,next:int>>"


def generation_table(
    model: NgramModel, temperature: float = 1.0, k: int | None = None, p: float | None = None
) -> DataFrame:
    """``[ctx, choice]`` after temperature, top-k and top-p, one row per seen context; temperature 0 is greedy.

    A choice is the same distribution that a table of all ``vocab`` tokens would give, without its rows: ``cuts`` are the
    slices of the seen tokens in token order, and the first ``free`` unseen tokens take ``unit`` each, between the cuts. It
    has at most as many cuts as the context has seen tokens.
    """
    ctx = Window.partitionBy("ctx")
    rows = model.counts.select("ctx", "next", "n", F.sum("n").over(ctx).alias("total"), F.count(F.lit(1)).over(ctx).alias("m"))
    if temperature == 0:
        best = rows.groupBy("ctx").agg(F.max_by("next", F.struct("n", -F.col("next"))).alias("next"))
        cut = F.array(F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"), F.col("next"))).cast(CUT)
        return best.select("ctx", F.struct(cut.alias("cuts"), F.lit(0.0).alias("unit"), F.lit(0).cast("bigint").alias("free")).alias("choice"))
    heat = float(max(temperature, 1e-6))
    rows = rows.withColumns({"logit": model.logp(F.col("n"), F.col("total")) / heat, "_floor": model.logp(F.lit(0), F.col("total")) / heat})
    top = F.max("logit").over(ctx)
    rows = rows.withColumns({"p": F.exp(F.col("logit") - top), "unit": F.exp(F.col("_floor") - top), "free": F.lit(model.vocab) - F.col("m")})
    rows = _shared(rows, ctx)
    # an unseen token is less likely than any seen one, so it is cut off first
    ranked = Window.partitionBy("ctx").orderBy(F.desc("logit"))
    if k is not None and k < model.vocab:
        rows = rows.withColumn("_r", F.rank().over(ranked)).filter(F.col("_r") <= k)
        rows = _shared(rows.withColumn("free", F.when(F.col("m") < k, F.col("free")).otherwise(F.lit(0))), ctx)
    if p is not None and 0.0 < p < 1.0:
        order = Window.partitionBy("ctx").orderBy(F.desc("logit"), "next")
        running = F.sum("p").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        held = F.sum("p").over(ctx)
        rows = rows.withColumns({"_c": running, "_r": F.row_number().over(order), "_held": held})
        fits = F.floor((F.lit(p) - F.col("_held")) / F.col("unit")).cast("bigint")
        rows = rows.withColumn("free", F.when(F.col("_held") <= p, F.least(F.col("free"), fits)).otherwise(F.lit(0).cast("bigint")))
        rows = _shared(rows.filter((F.col("_r") == 1) | (F.col("_c") <= p)), ctx)
    by_token = Window.partitionBy("ctx").orderBy("next")
    seen = F.sum("p").over(by_token.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # where unseen tokens are left no seen one was cut off, so the row number counts all seen tokens up to here
    below = F.least(F.col("next") - F.row_number().over(by_token) + 1, F.col("free"))
    ends = (F.lead("next").over(by_token).isNull()) & (below == F.col("free"))
    rows = rows.withColumn("hi", F.when(ends, F.lit(1.0)).otherwise(seen + below * F.col("unit")))
    cut = F.struct((F.col("hi") - F.col("p")).alias("lo"), "hi", F.col("next").cast("int").alias("next"))
    grouped = rows.groupBy("ctx").agg(F.array_sort(F.collect_list(F.struct("next", cut.alias("cut")))).alias("c"), F.max("unit").alias("unit"), F.max("free").alias("free"))
    cuts = F.transform("c", lambda c: c["cut"]).cast(CUT)
    return grouped.select("ctx", F.struct(cuts.alias("cuts"), "unit", F.col("free").cast("bigint").alias("free")).alias("choice"))


def _shared(rows: DataFrame, ctx) -> DataFrame:
    """Shares of the kept tokens, seen and unseen, add up to 1 again."""
    total = F.sum("p").over(ctx) + F.col("free") * F.col("unit")
    return rows.withColumn("_z", total).withColumns({"p": F.col("p") / F.col("_z"), "unit": F.col("unit") / F.col("_z")}).drop("_z")


def unseen_choice(model: NgramModel, temperature: float = 1.0, p: float | None = None) -> Column:
    """The choice of a context without counts: all tokens alike. Ties at the k-th stay, so top-k keeps all."""
    free = 1 if temperature == 0 else model.vocab
    if temperature and p is not None and 0.0 < p < 1.0:
        free = max(1, int(p * model.vocab))
    none = F.array().cast(CUT)
    return F.struct(none.alias("cuts"), F.lit(1.0 / free).alias("unit"), F.lit(free).cast("bigint").alias("free"))


def pick(choice: Column, u: Column, vocab: int) -> Column:
    """Token whose slice holds ``u``: a binary search over the cuts, then the rank among the unseen tokens between two of them."""
    cuts, size = choice["cuts"], F.size(choice["cuts"])
    powers = [1 << b for b in range(max(vocab, 2).bit_length(), -1, -1)]

    def narrow(low: Column, step: Column) -> Column:
        return F.when((low + step <= size) & (F.get(cuts, low + step - 1)["hi"] <= u), low + step).otherwise(low)

    passed = F.aggregate(F.array(*[F.lit(x) for x in powers]), F.lit(0), narrow)

    def chosen(at: Column) -> Column:
        here, before = F.get(cuts, at), F.get(cuts, at - 1)
        first = F.coalesce(before["next"] + 1, F.lit(0))
        rank = F.floor((u - F.coalesce(before["hi"], F.lit(0.0))) / choice["unit"]).cast("int")
        last = F.coalesce(here["next"], F.lit(vocab)) - 1
        unseen = F.least(first + rank, last, F.when(size == 0, choice["free"].cast("int") - 1))
        return F.when(here["lo"] <= u, here["next"]).otherwise(unseen)

    return let(passed, chosen)


def _start_ids(prompt_ids: Column, block_size: int) -> Column:
    """Last ``block_size`` tokens; an empty prompt starts from byte 10."""
    return F.when(F.size(prompt_ids) == 0, F.array(F.lit(10))).otherwise(tail(prompt_ids, block_size))


def generate(
    prompts: DataFrame,
    model: NgramModel,
    max_new: int,
    key: str,
    temperature: float = 1.0,
    k: int | None = None,
    p: float | None = None,
    seed: int = 0,
    group_size: int = 1,
    block_size: int = 256,
    eos: int | None = EOS_ID,
) -> DataFrame:
    """``[key, sample, ids]``: up to ``max_new`` new tokens per prompt (column ``prompt_ids``).

    A bounded order-2 model travels as one row per query (at most 65,536 cuts), and
    every prompt is extended inside its own row, without a shuffle. Larger models use one
    equi-join per step over all prompts. Both draw by the same rule, unseen tokens and contexts included.
    """
    rows = prompts.select(
        key,
        F.explode(F.sequence(F.lit(0), F.lit(group_size - 1))).alias("sample"),
        _start_ids(F.col("prompt_ids"), block_size).alias("start"),
    )
    table = generation_table(model, temperature, k, p)
    unseen = unseen_choice(model, temperature, p)
    if model.bounded and model.order == 2:
        return _generate_in_row(rows, table, unseen, max_new, key, seed, eos, model.vocab)
    return _generate_by_join(rows, table, unseen, model, max_new, key, seed, eos)


def _generate_in_row(rows, table, unseen, max_new, key, seed, eos, vocab):
    whole = table.agg(F.map_from_entries(F.collect_list(F.struct("ctx", "choice"))).alias("m"))
    # one value: a slot per possible context
    slots = F.sequence(F.lit(0), F.lit(vocab - 1))
    table = whole.select(F.transform(slots, lambda c: F.coalesce(F.try_element_at("m", c.cast("bigint")), unseen)).alias("choices")).scalar()

    def step(out: Column, i: Column) -> Column:
        last = F.coalesce(F.try_element_at(out, F.lit(-1)), F.try_element_at("start", F.lit(-1)))
        u = tx.uniform(F.lit(seed), key, "sample", i)
        nxt = let(u, lambda x: pick(F.get("_table", last), x, vocab))
        done = F.lit(False) if eos is None else F.coalesce(F.try_element_at(out, F.lit(-1)) == eos, F.lit(False))
        return F.when(done, out).otherwise(let(nxt, lambda n: F.concat(out, F.array(n))))

    steps = F.sequence(F.lit(0), F.lit(max_new - 1))
    empty = F.array().cast("array<int>")
    new = F.aggregate(steps, empty, step)
    return rows.withColumn("_table", table).select(key, "sample", F.col("start").alias("prompt_ids"), new.alias("new_ids"))


def _generate_by_join(rows, table, unseen, model, max_new, key, seed, eos):
    def context(seq: Column) -> Column:
        ctx = F.lit(0).cast("bigint")
        for back in range(model.order - 1, 0, -1):
            ctx = ctx * model.vocab + F.coalesce(F.get(seq, F.size(seq) - back), F.lit(0)).cast("bigint")
        return ctx

    table = cut_lineage(table)
    state = rows.select(
        key, "sample", F.col("start").alias("prompt_ids"), F.array().cast("array<int>").alias("new_ids"), F.lit(False).alias("done")
    )
    for i in range(max_new):
        # finished rows get contexts that no model has, all different, and find no match. One reference to ``state`` per
        # step, and a direct shuffle on both sides, so adaptive execution can split a hot context.
        ended = F.lit(-1).cast("bigint") - F.pmod(F.xxhash64(key, "sample"), F.lit(1 << 40))
        live = state.withColumn("ctx", F.when(F.col("done"), ended).otherwise(context(F.concat("prompt_ids", "new_ids"))))
        joined = live.join(table, "ctx", "left").withColumn("choice", F.coalesce("choice", unseen))
        u = tx.uniform(F.lit(seed), key, "sample", F.lit(i))
        joined = joined.withColumn("nxt", let(u, lambda x: pick(F.col("choice"), x, model.vocab)))
        nxt = F.col("nxt")
        over = F.lit(False) if eos is None else nxt == eos
        state = joined.select(
            key,
            "sample",
            "prompt_ids",
            F.when(F.col("done"), F.col("new_ids")).otherwise(F.concat("new_ids", F.array(nxt))).alias("new_ids"),
            (F.col("done") | over).alias("done"),
        )
        if i % 8 == 7:
            state = cut_lineage(state)
    return state.select(key, "sample", "prompt_ids", "new_ids")
