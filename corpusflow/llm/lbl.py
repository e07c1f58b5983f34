"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation, in two factors.

Words of all training documents are counted by Spark. First factor: the ``SHORT`` most frequent words, the end of a text and "any
other word" are classes; the two classes before a token, each through a matrix of its own, predict its class. Second
factor: every other training word has a vector and a bias of its own. Words are dealt by hash into buckets of about ``BUCKET``; a
bucket has its share of the counts, and the vector of the latest class word before the token, as the first factor learnt it,
predicts the word inside its bucket. So every training word has a vector, tables grow with the distinct words, and
the probabilities of all words (with one unknown word of count 0) add up to one in every context.

Training tokens are counted once, as class triples in a written table, dealt into tasks of ``TASK_TRIPLES``. In each of ``ROUNDS``
rounds every partition walks all its triples ``PASSES`` times in noise-contrastive steps in numpy, each triple weighted by its
count, from the same weights; their averages, weighted by tokens, start the next round. So every token counts in every pass
and the steps follow the triples. The driver only holds the weights (a few thousand numbers per partition). For the second factor
(class, word) counts meet by bucket; a bucket is trained whole in one task, against words drawn from it by their counts, so
nothing is averaged, and no group is hot: a word has at most one cell for each class and piece of texts that counted it.

Scoring computes the normaliser of every context by matrix products. Counts and vectors of at most ``HEAD`` most frequent words are
sent to the tasks. All other words are dealt by bucket into parts: a piece of texts sends each part its tokens in one row, these meet
the words of the part in one task, and their sums go back to the piece. So no vocabulary is ever held whole.

Edge cases: null and empty texts are one end token. Rows equal in id and text give a row each. An empty training
table leaves every word unknown (base probability as the formula says) and ``score`` equal to ``base_score``. An empty table
gives an empty result. Words are told apart by 64-bit hashes. Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.storage import cut_lineage
from .common import mix, shuffle_width, slices, words

SHORT = 255
HEAD = 1 << 17
BUCKET = 64
WIDTH = 16
NOISE = 128
ROUNDS = 3
PASSES = 3
LEAST_STEPS = 32
BATCH = 4096
TASK_TRIPLES = 65_536
TASK_TOKENS = 1 << 21
TASK_WORDS = 1 << 17
WORD_NOISE = 4
WORD_DRAWS = 8
WORD_STEPS = 20
WORD_BLOCK = 512
WORD_RATE = 0.1
WORD_PENALTY = 32.0
CHUNK = 1 << 15
PIECE = 1 << 24
SLICE = 1 << 20
RATE = 0.02
ALPHA = 0.1
END = int(mix(np.array([0xE0D], np.uint64))[0])
_INDEX_LOG2 = 20


@dataclass(frozen=True)
class Counts:
    """Sizes of the training text and its most frequent words."""

    tokens: int
    distinct: int
    head: np.ndarray  # sorted hashes
    head_count: np.ndarray
    short: np.ndarray  # sorted hashes of the classes; class k is short[k], the last class is any other word

    @property
    def mass(self) -> float:
        return self.tokens + ALPHA * (self.distinct + 1)

    @property
    def head_buckets(self) -> int:
        return len(self.head) // BUCKET + 1

    @property
    def buckets(self) -> int:
        return self.head_buckets + (self.distinct - len(self.head)) // BUCKET + 1

    def bucket(self, word: np.ndarray, in_head: np.ndarray) -> np.ndarray:
        """Bucket of each word: head words share buckets among themselves."""
        tail = self.head_buckets + (word % np.uint64(self.buckets - self.head_buckets)).astype(np.int64)
        return np.where(in_head, (word % np.uint64(self.head_buckets)).astype(np.int64), tail)

    @property
    def classes(self) -> int:
        return len(self.short) + 1

    def log_share(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + ALPHA) / self.mass)

    def class_shares(self) -> np.ndarray:
        at = Finder(self.head).find(self.short)
        own = (np.where(at >= 0, self.head_count[at] if len(self.head) else 0, 0) + ALPHA) / self.mass
        return np.append(own, max(1 - own.sum(), 1e-12))


class Finder:
    """Places of hashes in a sorted array, by an index on their leading bits."""

    def __init__(self, known: np.ndarray) -> None:
        self.known = known
        self.shift = np.uint64(64 - _INDEX_LOG2)
        lead = (known >> self.shift).astype(np.int64)
        sizes = np.bincount(lead, minlength=1 << _INDEX_LOG2)
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        lead = (hashes >> self.shift).astype(np.int64)
        at, end = self.first[lead], self.first[lead + 1]
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.flatnonzero(at < end)
        at, end, wanted = at[open_], end[open_], hashes[open_]
        while len(open_):
            hit = self.known[at] == wanted
            out[open_[hit]] = at[hit]
            on = np.flatnonzero(~hit & (at + 1 < end))
            open_, at, end, wanted = open_[on], at[on] + 1, end[on], wanted[on]
        return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def token_stream(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, an end behind each, and the offsets of each text."""
    hashes, at = words(array)
    offsets = at + np.arange(len(at))
    out = np.full(offsets[-1], np.uint64(END))
    room = np.ones(len(out), bool)
    room[offsets[1:] - 1] = False
    out[room] = hashes
    return out, offsets


def pieces(batches: Iterable[pa.RecordBatch], limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Row ranges of batches whose texts stay near ``limit`` bytes; they are read in slices of ``SLICE``, as hashing takes many times their size."""
    return (piece for batch in batches for piece in slices(batch, "_text", limit))


def word_counts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``[word, n]`` over all tokens, counted inside tasks first."""

    def run(batches):
        for piece in pieces(batches, 2 * PIECE):
            found, n = np.unique(np.concatenate([token_stream(part.column("_text"))[0] for part in slices(piece, "_text", SLICE)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(_signed(found)), pa.array(n)], ["word", "n"])

    counted = docs.select(F.col(text_column).alias("_text")).mapInArrow(run, "word long, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def summary(counts: DataFrame) -> Counts:
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # the least count of the head comes from a histogram (64 steps a doubling), so no task sorts the vocabulary
    step = F.floor(F.log2("n") * 64).cast("int")
    sizes = sorted(((r["step"], r["size"]) for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("size")).collect()), reverse=True)
    least, held = 1 << 30, 0
    for at, size in sizes:
        held += size
        if held > HEAD:
            break
        least = at
    top = counts.filter((step >= least) | (F.col("word") == END - (1 << 64 if END >> 63 else 0))).toPandas()  # HEAD rows and the end
    word = top["word"].to_numpy(np.int64).view(np.uint64)
    n = top["n"].to_numpy(np.int64)
    order = np.lexsort((word, -n))
    frequent = word[order]
    order = np.argsort(word)
    short = np.unique(np.append(frequent[frequent != np.uint64(END)][:SHORT], np.uint64(END)))
    return Counts(int(tokens), int(distinct), word[order], n[order], short)


def _contexts(classes: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """Number of the two classes before each token; ``size`` stands for the time before a text."""
    before = np.full((2, len(classes)), size, np.int64)
    for back in (1, 2):
        before[back - 1, back:] = classes[:-back]
        for k in range(back):
            starts = offsets[:-1] + k
            before[back - 1, starts[starts < offsets[1:]]] = size
    return before[1] * (size + 1) + before[0]


def _recent(classes: np.ndarray, offsets: np.ndarray, other: int) -> np.ndarray:
    """The latest class before each token that is a word's own; ``other + 1`` where its text has none yet."""
    last = np.full(len(classes), -1, np.int64)
    last[1:] = np.maximum.accumulate(np.where(classes != other, np.arange(len(classes)), -1))[:-1]
    return np.where(last >= np.repeat(offsets[:-1], np.diff(offsets)), classes[last], other + 1)


def class_triples(docs: DataFrame, counts: Counts, text_column: str = "text") -> DataFrame:
    """``[code, n]``: how often a class follows two classes, over all tokens."""
    sent = docs.sparkSession.sparkContext.broadcast(counts.short)  # SHORT hashes
    size = counts.classes

    def run(batches):
        finder = Finder(sent.value)
        for piece in pieces(batches, 2 * PIECE):
            held = []
            for part in slices(piece, "_text", SLICE):
                tokens, offsets = token_stream(part.column("_text"))
                found = finder.find(tokens)
                classes = np.where(found < 0, size - 1, found)
                held.append((_contexts(classes, offsets, size) * size + classes).astype(np.int32))  # below (SHORT + 3) ** 3
            code, n = np.unique(np.concatenate(held), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array(n)], ["code", "n"])

    counted = docs.select(F.col(text_column).alias("_text")).mapInArrow(run, "code long, n long")
    return counted.groupBy("code").agg(F.sum("n").alias("n"))


def shared_out(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and weight of parts of all counts: no part is above the mean, so there are at most two parts a count."""
    times = np.ceil(n / n.mean()).astype(np.int64)
    return np.repeat(np.arange(len(n)), times), np.repeat(n / times, times)


def _add_rows(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Add each row to the row ``at`` of a table."""
    cells = (at[:, None] * table.shape[1] + np.arange(table.shape[1])).reshape(-1)
    table += np.bincount(cells, rows.reshape(-1), table.size).reshape(table.shape).astype(table.dtype)


class LogBilinear:
    """Class vectors ``r`` of contexts, one matrix per position, class vectors ``q`` and biases of targets."""

    def __init__(self, shares: np.ndarray, seed: int = 9) -> None:
        rng = np.random.default_rng(seed)
        size = len(shares)
        self.shares = shares
        self.p = {
            "r": (rng.standard_normal((size + 1, WIDTH)) * 0.3).astype(np.float32),
            "c": np.stack([np.eye(WIDTH)] * 2).astype(np.float32),
            "q": (rng.standard_normal((size, WIDTH)) * 0.05).astype(np.float32),
            "b": np.log(shares).astype(np.float32),
        }

    def train(self, code: np.ndarray, n: np.ndarray, seed: int, passes: int, speed: float = RATE) -> None:
        """Noise-contrastive steps over all triples in random order, weighted by count, against ``NOISE`` classes drawn by share.

        The noise is shared by a batch; few triples are walked in smaller batches, so that a pass has ``LEAST_STEPS`` of them.
        """
        size = len(self.shares)
        rng = np.random.default_rng(seed)
        place, weight = shared_out(n)
        batch = min(BATCH, -(-len(place) // LEAST_STEPS))
        weight = (weight / weight.mean()).astype(np.float32)
        steps = passes * -(-len(place) // batch)
        log_noise = np.log(NOISE * self.shares).astype(np.float32)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        walk = (order[i : i + batch] for order in (rng.permutation(len(place)) for _ in range(passes)) for i in range(0, len(order), batch))
        for step, at in enumerate(walk, 1):
            drawn, part = code[place[at]], weight[at] / batch
            target, context = drawn % size, drawn // size
            far, near = context // (size + 1), context % (size + 1)
            noise = rng.choice(size, NOISE, p=self.shares / self.shares.sum())
            p = self.p
            far_r, near_r = p["r"][far], p["r"][near]
            guess = far_r @ p["c"][0] + near_r @ p["c"][1]
            true = (guess * p["q"][target]).sum(axis=1) + p["b"][target] - log_noise[target]
            false = guess @ p["q"][noise].T + p["b"][noise] - log_noise[noise]
            d_true = (1 / (1 + np.exp(-np.clip(true, -30, 30))) - 1) * part
            d_false = 1 / (1 + np.exp(-np.clip(false, -30, 30))) * part[:, None]
            d_guess = d_true[:, None] * p["q"][target] + d_false @ p["q"][noise]
            slope = {k: np.zeros_like(v) for k, v in p.items()}
            _add_rows(slope["q"], target, d_true[:, None] * guess)
            np.add.at(slope["q"], noise, d_false.T @ guess)
            np.add.at(slope["b"], target, d_true)
            np.add.at(slope["b"], noise, d_false.sum(axis=0))
            slope["c"][0], slope["c"][1] = far_r.T @ d_guess, near_r.T @ d_guess
            _add_rows(slope["r"], far, d_guess @ p["c"][0].T)
            _add_rows(slope["r"], near, d_guess @ p["c"][1].T)
            for k, g in slope.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                rate = speed * (1 - 0.8 * step / steps)
                p[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """Predicted vector and log normaliser of every context, by matrix products over blocks of contexts."""
        size = len(self.shares)
        far, near = self.p["r"] @ self.p["c"][0], self.p["r"] @ self.p["c"][1]
        guess = (far[:, None, :] + near[None, :, :]).reshape(-1, WIDTH)
        norm = np.empty(len(guess))
        for i in range(0, len(guess), 4096):
            scores = guess[i : i + 4096] @ self.p["q"].T + self.p["b"]
            top = scores.max(axis=1)
            norm[i : i + 4096] = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
        assert len(guess) == (size + 1) ** 2
        return guess, norm

    def log10(self, guess: np.ndarray, norm: np.ndarray, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        scores = np.einsum("nd,nd->n", guess[context], self.p["q"][target]) + self.p["b"][target]
        return (scores - norm[context]) / np.log(10)


def train(triples: DataFrame, counts: Counts, rounds: int = ROUNDS, passes: int = PASSES) -> LogBilinear:
    """Rounds of parallel noise-contrastive training with averaged weights; a partition that is lost is run again alike."""
    model = LogBilinear(counts.class_shares())
    context = triples.sparkSession.sparkContext
    names = list(model.p)
    for turn in range(rounds):
        sent = context.broadcast(model)

        def run(batches, sent=sent, turn=turn):
            held = [(b.column("code").to_numpy(), b.column("n").to_numpy()) for b in batches]
            code, n = (np.concatenate([np.zeros(0, np.int64), *(h[k] for h in held)]) for k in (0, 1))
            if len(code):
                order = np.argsort(code)
                own = LogBilinear(sent.value.shares)
                own.p = {k: v.copy() for k, v in sent.value.p.items()}
                own.train(code[order], n[order], 100 * turn + int(code.min() % 97), passes)
                weights = np.concatenate([own.p[k].reshape(-1) for k in names]).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([float(n.sum())]), pa.array([weights.tobytes()], pa.binary())], ["tokens", "weights"])

        found = triples.mapInArrow(run, "tokens double, weights binary").collect()  # one set of weights per partition
        if not found:
            return model
        total = sum(r["tokens"] for r in found)
        mean = sum(np.frombuffer(r["weights"]) * (r["tokens"] / total) for r in found)
        at = 0
        for k in names:
            size = model.p[k].size
            model.p[k] = mean[at : at + size].reshape(model.p[k].shape).astype(np.float32)
            at += size
        sent.unpersist()
    return model


def _parts(known: Counts) -> int:
    return max(1, -(-known.tokens // TASK_TOKENS), -(-known.distinct // TASK_WORDS))


def _packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of ``values`` between neighbouring cuts, one binary each."""
    return pa.array([values[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])], pa.binary())


def _unpacked(columns: Iterable[pa.Array], kind: type) -> np.ndarray:
    """All binaries end to end as numbers; null is empty."""
    held = [np.zeros(0, kind)]
    for column in columns:
        column = pc.fill_null(column, b"").cast(pa.large_binary())
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
        if at[-1] > at[0]:
            held.append(np.frombuffer(data, kind, int(at[-1] - at[0]) // np.dtype(kind).itemsize, int(at[0])))
    return np.concatenate(held)


def word_cells(docs: DataFrame, known: Counts, text_column: str = "text") -> DataFrame:
    """``[part, words, sizes, recent, n]``: how often a word without a class comes after its latest class word, added up inside tasks.

    One row holds what texts of about ``PIECE`` bytes have for the buckets of a part: words, the number of classes each follows, these classes and the counts.
    """
    sent = docs.sparkSession.sparkContext.broadcast(known)
    size = known.classes + 1
    parts = _parts(known)

    def run(batches):
        known = sent.value
        head, short = Finder(known.head), Finder(known.short)
        for piece in pieces(batches):
            held = []
            for part in slices(piece, "_text", SLICE):
                tokens, offsets = token_stream(part.column("_text"))
                found = short.find(tokens)
                classes = np.where(found < 0, known.classes - 1, found)
                open_ = np.flatnonzero(found < 0)
                held.append((tokens[open_], _recent(classes, offsets, known.classes - 1)[open_].astype(np.int16)))
            word, recent = (np.concatenate(x) for x in zip(*held))
            if len(word):
                names, code = np.unique(word, return_inverse=True)
                part = known.bucket(names, head.find(names) >= 0) % parts
                order = np.argsort(part, kind="stable")
                place = np.empty(len(names), np.int64)
                place[order] = np.arange(len(names))
                cell, n = np.unique(place[code] * size + recent, return_counts=True)
                sizes = np.bincount(cell // size, minlength=len(names))
                part = part[order]
                cuts = np.append(_firsts(part), len(part))
                cell_cuts = np.append(0, np.cumsum(sizes))[cuts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part[cuts[:-1]].astype(np.int32)),
                        _packed(names[order], cuts),
                        _packed(sizes.astype(np.int32), cuts),
                        _packed((cell % size).astype(np.int16), cell_cuts),
                        _packed(n.astype(np.int32), cell_cuts),
                    ],
                    ["part", "words", "sizes", "recent", "n"],
                )

    return docs.select(F.col(text_column).alias("_text")).mapInArrow(run, "part int, words binary, sizes binary, recent binary, n binary")


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Places where sorted rows change."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new)


def fit_words(bucket: np.ndarray, word: np.ndarray, recent: np.ndarray, n: np.ndarray, features: np.ndarray, seed: int):
    """Vectors of all words of whole buckets by noise-contrastive steps.

    Rows are sorted by (bucket, word, recent) and distinct. Returned are the first row of each word, its count, its
    weights, the place of the first word of each bucket and the log of the sum of all words' scores in each bucket by class.
    """
    rng = np.random.default_rng(seed)
    first = _firsts(bucket, word)
    owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(word))))
    count = np.add.reduceat(n, first)
    begin = _firsts(bucket[first])
    group = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(first))))
    mass = np.add.reduceat(count + ALPHA, begin)
    share = (count + ALPHA) / mass[group]
    # noise: WORD_NOISE words of the bucket for a token, drawn at most WORD_DRAWS times for a row and weighted up beyond
    times = np.minimum(n, WORD_DRAWS) * WORD_NOISE
    high = np.cumsum(share)
    low = np.append(0, high)[begin]
    row = np.repeat(np.arange(len(n)), times)
    of = group[owner[row]]
    top = np.append(low[1:], high[-1])
    drawn = np.searchsorted(high, low[of] + rng.random(len(row)) * (top - low)[of], "right")
    drawn = np.clip(drawn, begin[of], np.append(begin[1:], len(first))[of] - 1)
    size = len(features)
    cell, where = np.unique(np.concatenate([owner * size + recent, drawn * size + recent[row]]), return_inverse=True)
    true = np.bincount(where[: len(n)], n, len(cell)).astype(np.float32)
    both = true + np.bincount(where[len(n) :], (n * WORD_NOISE / times)[row], len(cell)).astype(np.float32)
    at = cell // size
    weights = np.zeros((len(first), features.shape[1] + 1), np.float32)
    weights[:, -1] = np.log(share)
    start, offset = weights[:, -1].copy(), np.log(WORD_NOISE * share)[at].astype(np.float32)
    # a few words at a time against all classes by matrix products, of which only the cells that occur are used
    full = np.hstack([features, np.ones((size, 1), np.float32)])
    across = np.ascontiguousarray(full.T)
    blocks = [(i, min(i + WORD_BLOCK, len(first))) for i in range(0, len(first), WORD_BLOCK)]
    cuts = np.searchsorted(at, [i for i, _ in blocks] + [len(first)])
    scores, errors = (np.zeros((WORD_BLOCK, size), np.float32) for _ in range(2))
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, WORD_STEPS + 1):
        slope = WORD_PENALTY * weights
        slope[:, -1] = weights[:, -1] - start
        for k, (i, j) in enumerate(blocks):
            some = slice(cuts[k], cuts[k + 1])
            place = cell[some] - i * size
            score = np.matmul(weights[i:j], across, out=scores[: j - i]).reshape(-1)[place] - offset[some]
            flat = errors.reshape(-1)
            flat[place] = both[some] / (1 + np.exp(-np.clip(score, -30, 30))) - true[some]
            slope[i:j] += errors[: j - i] @ full
            flat[place] = 0
        m, v = 0.8 * m + 0.2 * slope, 0.95 * v + 0.05 * slope * slope
        rate = WORD_RATE * (1 - 0.9 * step / WORD_STEPS)
        weights -= rate * (m / (1 - 0.8**step)) / (np.sqrt(v / (1 - 0.95**step)) + 1e-8)
    weights = weights.astype(np.float16)  # as they are kept, so that normalisers fit
    scores = weights[:, :-1].astype(np.float32) @ features.T + weights[:, -1:].astype(np.float32)
    peak = np.maximum.reduceat(scores, begin)
    norm = peak + np.log(np.add.reduceat(np.exp(scores - peak[group]), begin))
    return first, count, weights, begin, norm


def train_words(cells: DataFrame, known: Counts, features: np.ndarray) -> DataFrame:
    """``[bucket, word, n, weights]`` of every word without a class, and ``[bucket, null, null, shares]`` of its buckets.

    ``shares`` holds, for each class, the log10 of the bucket's part of "any other word" less the log10 of its normaliser.
    """
    sent = cells.sparkSession.sparkContext.broadcast((known, features))
    mass = known.mass * known.class_shares()[-1]

    def run(batches):
        known, features = sent.value
        held = [[b.column(k) for k in ("words", "sizes", "recent", "n")] for b in batches]
        if not held:
            return
        kinds = (np.uint64, np.int32, np.int16, np.int32)
        word, sizes, recent, n = (_unpacked(x, kind) for x, kind in zip(zip(*held), kinds))
        del held
        names, code = np.unique(word, return_inverse=True)
        bucket = known.bucket(names, Finder(known.head).find(names) >= 0)
        by_bucket = np.argsort(bucket, kind="stable")
        place = np.empty(len(names), np.int64)
        place[by_bucket] = np.arange(len(names))
        cell = np.repeat(place[code] * len(features), sizes) + recent
        order = np.argsort(cell)  # by bucket, word and class
        cell = cell[order]
        first = _firsts(cell)
        n = np.add.reduceat(n[order], first, dtype=np.int64)
        owner, recent = np.divmod(cell[first], len(features))
        owner = by_bucket[owner]
        bucket, word = bucket[owner], _signed(names[owner])
        ends = np.append(_firsts(bucket)[1:], len(bucket))
        begin = 0
        while begin < len(bucket):  # whole buckets of about CHUNK rows
            end = int(ends[min(np.searchsorted(ends, begin + CHUNK), len(ends) - 1)])
            b, w = bucket[begin:end], word[begin:end]
            first, count, weights, groups, norm = fit_words(b, w, recent[begin:end], n[begin:end], features, int(b[0]))
            share = np.log10(np.add.reduceat(count + ALPHA, groups) / mass)[:, None] - norm / np.log(10)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(b[first], b[first][groups])),
                    pa.concat_arrays([pa.array(w[first]), pa.nulls(len(groups), pa.int64())]),
                    pa.concat_arrays([pa.array(count), pa.nulls(len(groups), pa.int64())]),
                    pa.array([x.tobytes() for x in weights] + [x.tobytes() for x in share.astype(np.float32)], pa.binary()),
                ],
                ["bucket", "word", "n", "weights"],
            )
            begin = end

    return cells.repartitionById(_parts(known), "part").mapInArrow(run, "bucket long, word long, n long, weights binary")


def class_features(model: LogBilinear) -> np.ndarray:
    """What the latest class tells, as the first factor learnt it, at a mean square of one; a last row of zeros for none."""
    near = (model.p["r"] @ model.p["c"][1])[:-1]
    near = (near - near.mean(axis=0)) / max(float(near.std()), 1e-6)
    return np.vstack([near, np.zeros((1, near.shape[1]))]).astype(np.float32)


@dataclass(frozen=True)
class HeadWords:
    """Weights of the head words in the order of ``Counts.head`` and shares of their buckets."""

    weights: np.ndarray
    shares: np.ndarray


def head_words(words: DataFrame, known: Counts, features: np.ndarray) -> HeadWords:
    weights = np.zeros((len(known.head), features.shape[1] + 1), np.float16)
    shares = np.zeros((known.head_buckets, len(features)), np.float32)
    head = words.filter(F.col("bucket") < known.head_buckets)
    own = head.filter(F.col("word").isNotNull()).select("word", "weights").toPandas()  # HEAD rows
    if len(own):
        at = np.searchsorted(known.head, own["word"].to_numpy(np.int64).view(np.uint64))
        weights[at] = np.stack([np.frombuffer(x, np.float16) for x in own["weights"]])
    groups = head.filter(F.col("word").isNull()).select("bucket", "weights").toPandas()  # a row for BUCKET of them
    if len(groups):
        shares[groups["bucket"].to_numpy()] = np.stack([np.frombuffer(x, np.float32) for x in groups["weights"]])
    return HeadWords(weights, shares)


def _word_log10(weights: np.ndarray, shares: np.ndarray, features: np.ndarray) -> np.ndarray:
    score = np.einsum("nd,nd->n", weights[:, :-1].astype(np.float32), features) + weights[:, -1]
    return score / np.log(10) + shares


class RareWords:
    """Words of a part outside the head: counts, weights and the shares of their buckets."""

    def __init__(self, batches: list[pa.RecordBatch], known: Counts) -> None:
        own, groups = ([b.filter(keep(b.column("word"))) for b in batches] for keep in (pc.is_valid, pc.is_null))
        word, bucket, n = (np.concatenate([np.zeros(0, np.int64), *(b.column(k).to_numpy() for b in own)]) for k in ("word", "bucket", "n"))
        order = np.argsort(word.view(np.uint64))
        self.known = known
        self.finder = Finder(word.view(np.uint64)[order])
        self.base = np.append(known.log_share(n[order]), known.log_share(np.zeros(1)))  # the last one of words never seen
        self.weights = _unpacked((b.column("weights") for b in own), np.float16).reshape(-1, WIDTH + 1)[order]
        name = np.concatenate([np.zeros(0, np.int64), *(b.column("bucket").to_numpy() for b in groups)])
        place = np.argsort(name)
        self.shares = _unpacked((b.column("weights") for b in groups), np.float32).reshape(-1, known.classes + 1)[place]
        self.group = np.searchsorted(name[place], bucket[order])

    def sums(self, batch: pa.RecordBatch, features: np.ndarray) -> pa.RecordBatch:
        """What the tokens of each row add to each document."""
        doc, word, recent = (_unpacked([batch.column(k)], kind) for k, kind in (("docs", np.int32), ("words", np.uint64), ("recents", np.int16)))
        at = self.finder.find(word)
        learnt = np.flatnonzero(at >= 0)
        inner = np.full(len(word), np.log10(ALPHA / (self.known.mass * self.known.class_shares()[-1])))
        if len(learnt):
            near, own = recent[learnt], at[learnt]
            inner[learnt] = _word_log10(self.weights[own], self.shares[self.group[own], near], features[near])
        sizes = pc.binary_length(batch.column("docs")).to_numpy() // 4
        first = _firsts(np.repeat(np.arange(batch.num_rows), sizes), doc)
        cuts = np.searchsorted(first, np.append(0, np.cumsum(sizes)))
        sums = (np.add.reduceat(x, first) for x in ((at >= 0).astype(np.int64), self.base[at], inner))
        return pa.RecordBatch.from_arrays([batch.column("origin"), *(_packed(x, cuts) for x in (doc[first], *sums))], ["origin", "docs", "known", "base", "inner"])


def score(docs: DataFrame, table: DataFrame, known: Counts, model: LogBilinear, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``[doc_id, n_tokens, n_known, base_score, score]``, one row per document."""
    features = class_features(model)
    sent = docs.sparkSession.sparkContext.broadcast((known, model, features, head_words(table, known, features)))  # HEAD words and the weights
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    parts = max(_parts(known), shuffle_width(docs.sparkSession))

    def run(batches):
        known, model, features, own = sent.value
        head, short = Finder(known.head), Finder(known.short)
        guess, norm = model.contexts()
        other = known.classes - 1
        origin = TaskContext.get().partitionId() << 32
        for piece in pieces(batches, PIECE // 2):
            held, done = [], 0
            for part in slices(piece, "_text", SLICE):
                tokens, offsets = token_stream(part.column("_text"))
                owner = np.repeat(np.arange(part.num_rows), np.diff(offsets))
                at, found = head.find(tokens), short.find(tokens)
                classes = np.where(found < 0, other, found)
                in_head = at >= 0
                base = np.where(in_head, known.log_share(known.head_count[at] if len(known.head) else np.zeros(len(at))), 0.0)
                neural = model.log10(guess, norm, _contexts(classes, offsets, known.classes), classes)
                # inside "any other word": head words by their vectors here, all others later
                recent = _recent(classes, offsets, other)
                inner = np.flatnonzero((classes == other) & in_head)
                near = recent[inner]
                neural[inner] += _word_log10(own.weights[at[inner]], own.shares[known.bucket(tokens[inner], True), near], features[near])
                sums = [np.bincount(owner, x, part.num_rows) for x in (in_head, base, neural)]
                rare = np.flatnonzero(~in_head)
                held.append((np.diff(offsets), *sums, (owner[rare] + done).astype(np.int32), tokens[rare], recent[rare].astype(np.int16)))
                done += part.num_rows
            times, n_known, base, neural, doc, word, recent = (np.concatenate(x) for x in zip(*held))
            to = known.bucket(word, False) % parts
            order = np.argsort(to, kind="stable")
            to = to[order]
            cuts = np.append(_firsts(to), len(to)) if len(to) else np.zeros(1, np.int64)
            n = len(cuts) - 1  # rows of words outside the head, one for each part that has some
            origin += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(done + n, origin)),
                    pa.concat_arrays([pa.nulls(done, pa.int32()), pa.array(to[cuts[:-1]].astype(np.int32))]),
                    pa.concat_arrays([pa.array(np.arange(done, dtype=np.int32)), pa.nulls(n, pa.int32())]),
                    pa.concat_arrays([piece.column("doc_id"), pa.nulls(n, piece.column("doc_id").type)]),
                    *(pa.concat_arrays([pa.array(x), pa.nulls(n, pa.array(x).type)]) for x in (times, n_known.astype(np.int64), base, neural)),
                    *(pa.concat_arrays([pa.nulls(done, pa.binary()), _packed(x[order], cuts)]) for x in (doc, word, recent)),
                ],
                ["origin", "part", "at", "doc_id", "times", "n_known", "base", "neural", "docs", "words", "recents"],
            )

    whole = f"origin long, part int, at int, doc_id {kind}, times long, n_known long, base double, neural double"
    found = cut_lineage(rows.mapInArrow(run, f"{whole}, docs binary, words binary, recents binary"))
    # each part has its words, which come first, and all their tokens
    words = table.filter(F.col("bucket") >= known.head_buckets).withColumn("part", (F.col("bucket") % parts).cast("int"))
    rare = found.filter(F.col("part").isNotNull()).select("part", "origin", "docs", "words", "recents")
    rare = words.unionByName(rare, allowMissingColumns=True).repartitionById(parts, "part").sortWithinPartitions(F.col("origin").asc_nulls_first())

    def meet(batches):
        known, _, features, _ = sent.value
        held, words = [], None
        for batch in batches:
            cut = batch.column("origin").null_count
            if cut:
                held.append(batch.slice(0, cut))
            if cut < batch.num_rows:
                words = words or RareWords(held, known)
                yield words.sums(batch.slice(cut), features)

    rare = rare.mapInArrow(meet, "origin long, docs binary, known binary, base binary, inner binary")

    def finish(rows, rare):
        doc = _unpacked(rare.column("docs").chunks, np.int32)
        added = [np.bincount(doc, _unpacked(rare.column(k).chunks, x), rows.num_rows) for k, x in (("known", np.int64), ("base", float), ("inner", float))]
        at = rows.column("at").to_numpy()
        out = [rows.column(k).to_numpy() + x[at] for k, x in zip(("n_known", "base", "neural"), added)]
        return pa.table([rows.column("doc_id"), rows.column("times"), pa.array(out[0].astype(np.int64)), *out[1:]], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    # an origin is a piece of a batch, so groups are small
    whole = found.filter(F.col("part").isNull()).select("origin", "at", "doc_id", "times", "n_known", "base", "neural")
    out = whole.groupBy("origin").cogroup(rare.groupBy("origin")).applyInArrow(finish, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
    return out if known.tokens else out.withColumn("score", F.col("base_score"))


def scored(docs: DataFrame, trains: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Count, train and score: ``[doc_id, n_tokens, n_known, train_tokens, base_score, score]``."""
    training = docs.filter(trains)
    counts = cut_lineage(word_counts(training, text_column))
    known = summary(counts)
    triples = cut_lineage(class_triples(training, known, text_column))
    parts = -(-triples.count() // TASK_TRIPLES) or 1
    model = train(cut_lineage(triples.repartition(parts)), known)
    table = cut_lineage(train_words(word_cells(training, known, text_column), known, class_features(model)))
    return score(docs, table, known, model, id_column, text_column).withColumn("train_tokens", F.lit(known.tokens).cast("long"))
