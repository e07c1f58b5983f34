"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are cut into windows of ``SPAN`` bytes, all of them read. Two gated recurrent layers run over a window in both directions,
every byte position gets a distribution over languages, and the mean over all positions is the document's.
Weights are trained in numpy by backpropagation through time with Adam, on at most ``FIT_DOCS`` documents for every
language (smallest hash of the id first). Of those every window is read: training draws as many windows as its steps look at, equally many
for each language, and of a language a document first and then any of its windows. Steps are added for each ``LANGUAGES`` languages. A window of under ``SHORT`` bytes
teaches only where it is the whole text and holds a letter.

Edge cases: a text that is null or holds no letter is ``und`` with score 0; texts of any length are read whole. A null language
teaches nothing; without any labelled text every prediction is ``und``. Repeated rows get equal predictions. An empty table
gives an empty result. The input row travels as a struct, so names cannot clash.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.storage import cut_lineage
from .common import carried, mix, raw_text, slices, text_in

SPAN = 96
HIDDEN = 12
FIT_DOCS = 300
LANGUAGES = 64
SHORT = 8
STEPS = 260
BATCH = 160
BLOCK = 2048
_MAYBE_LETTER = re.compile(r"[^\W\d_]")  # also number signs, which are no letters


def has_letter(text: str | None) -> bool:
    return bool(text) and any(m[0].isalpha() for m in _MAYBE_LETTER.finditer(text))


def windows(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all windows (time, window), their lengths, and the text of each."""
    counts = -(-np.diff(at) // SPAN)
    owner = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = at[owner] + inside * SPAN
    lengths = np.minimum(at[owner + 1] - begins, SPAN)
    padded = np.concatenate([data, np.zeros(SPAN, np.uint8)])
    return padded[begins[None, :] + np.arange(SPAN)[:, None]], lengths, owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(cell: dict, codes: np.ndarray, keep: bool, live: np.ndarray):
    """States of one direction over ``codes`` (time, window); a padded step keeps the state."""
    table, inner = cell["x"], cell["h"]
    size = inner.shape[1]
    state = np.zeros((size, codes.shape[1]), np.float32)
    states, traces, full = [], [], live.all(axis=1)
    for t in range(len(codes)):
        given, own = table[:, codes[t]], inner @ state
        gates = _sigmoid(given[: 2 * size] + own[: 2 * size])
        update, reset = gates[:size], gates[size:]
        fresh = np.tanh(given[2 * size :] + reset * own[2 * size :])
        mixed = fresh + update * (state - fresh)
        if not full[t]:
            mixed = np.where(live[t], mixed, state)
        if keep:
            traces.append((state, update, reset, fresh, own[2 * size :]))
        states.append(mixed)
        state = mixed
    return states, traces


def _unroll(cell: dict, codes: np.ndarray, traces: list, slopes: list, live: np.ndarray) -> dict:
    """Backpropagation through time: gradients of one direction from the slopes at its states."""
    inner = cell["h"]
    size = inner.shape[1]
    out = {"x": np.zeros_like(cell["x"]), "h": np.zeros_like(inner)}
    back = np.zeros_like(slopes[0])
    for t in reversed(range(len(codes))):
        state, update, reset, fresh, own = traces[t]
        slope = slopes[t] + back
        through = np.where(live[t], slope, 0)
        d_fresh = through * (1 - update) * (1 - fresh**2)
        d_update = through * (state - fresh) * update * (1 - update)
        d_reset = d_fresh * own * reset * (1 - reset)
        given = np.concatenate([d_update, d_reset, d_fresh])
        held = np.concatenate([d_update, d_reset, d_fresh * reset])
        np.add.at(out["x"].T, codes[t], given.T)
        out["h"] += held @ state.T
        back = slope - through + through * update + inner.T @ held
    return out


class Network:
    def __init__(self, languages: list[str], seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.cells = [
            {"x": (rng.standard_normal((3 * HIDDEN, 256)) * 0.3).astype(np.float32), "h": (rng.standard_normal((3 * HIDDEN, HIDDEN)) * 0.3).astype(np.float32)}
            for _ in range(2)
        ]
        self.out = {"w": np.zeros((len(languages), 2 * HIDDEN), np.float32), "b": np.zeros((len(languages), 1), np.float32)}

    def _positions(self, codes: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """Probabilities of every position (time, language, window)."""
        live = np.arange(len(codes))[:, None] < lengths[None, :]
        ahead, ahead_traces = _run(self.cells[0], codes, keep, live)
        behind, behind_traces = _run(self.cells[1], codes[::-1], keep, live[::-1])
        behind = behind[::-1]
        w, b = self.out["w"], self.out["b"]
        probabilities = np.empty((len(codes), len(self.languages), codes.shape[1]), np.float32)
        for t in range(len(codes)):
            logits = w[:, :HIDDEN] @ ahead[t] + w[:, HIDDEN:] @ behind[t] + b
            np.exp(logits - logits.max(axis=0), out=logits)
            probabilities[t] = logits / logits.sum(axis=0)
        return probabilities, live, (ahead, behind, ahead_traces, behind_traces)

    def train(self, codes: np.ndarray, lengths: np.ndarray, target: np.ndarray, steps: int = STEPS) -> None:
        rng = np.random.default_rng(7)
        parameters = [self.cells[0]["x"], self.cells[0]["h"], self.cells[1]["x"], self.cells[1]["h"], self.out["w"], self.out["b"]]
        first = [np.zeros_like(p) for p in parameters]
        second = [np.zeros_like(p) for p in parameters]
        for step in range(1, steps + 1):
            pick = rng.integers(0, codes.shape[1], BATCH)
            some, size, label = codes[:, pick], lengths[pick], target[pick]
            probabilities, live, (ahead, behind, ta, tb) = self._positions(some, size, True)
            error = probabilities
            error[:, label, np.arange(len(pick))] -= 1
            error *= (live / live.sum()).astype(np.float32)[:, None, :]
            w = self.out["w"]
            d_w, d_b = np.zeros_like(w), error.sum(axis=(0, 2))[:, None]
            sa, sb = [], []
            for t in range(len(some)):
                d_w[:, :HIDDEN] += error[t] @ ahead[t].T
                d_w[:, HIDDEN:] += error[t] @ behind[t].T
                sa.append(w[:, :HIDDEN].T @ error[t])
                sb.append(w[:, HIDDEN:].T @ error[t])
            ga = _unroll(self.cells[0], some, ta, sa, live)
            gb = _unroll(self.cells[1], some[::-1], tb, sb[::-1], live[::-1])
            rate = 0.02 * (1 - step / (steps + 1))
            for k, slope in enumerate((ga["x"], ga["h"], gb["x"], gb["h"], d_w, d_b)):
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.99 * second[k] + 0.01 * slope**2
                parameters[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)

    def pooled(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Mean distribution over all positions of each text; zeros for an empty one."""
        codes, lengths, owner = windows(data, at)
        sums = np.zeros((len(at) - 1, len(self.languages)))
        block = max(1, BLOCK * LANGUAGES // max(LANGUAGES, len(self.languages)))  # the same memory for any number of languages
        for group in (np.flatnonzero(lengths == SPAN), np.flatnonzero(lengths < SPAN)):
            for i in range(0, len(group), block):
                some = group[i : i + block]
                probabilities, live, _ = self._positions(codes[:, some], lengths[some])
                np.add.at(sums, owner[some], np.einsum("tlw,tw->wl", probabilities, live.astype(np.float32)))
        return sums / np.maximum(np.diff(at), 1)[:, None]


def fit(docs: DataFrame, trains: Column, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> Network | None:
    """Train on the rows where ``trains`` holds; the sample is bounded by ``FIT_DOCS`` documents a language."""
    rows = docs.filter(trains & F.col(lang_column).isNotNull()).select(F.col(lang_column).alias("lang"), F.col(id_column).alias("id"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    chosen = rows.withColumn("rank", rank).filter(F.col("rank") <= FIT_DOCS)
    chosen = cut_lineage(chosen.select(F.col("id").alias("_id"), F.col("lang").alias("_lang")).distinct())
    found = max(1, chosen.select("_lang").distinct().count())
    rounds = -(-found // LANGUAGES)
    draws = -(-STEPS * BATCH * rounds // found)  # windows that training reads of each language
    texts = docs.select(F.col(id_column).alias("_id"), F.col(lang_column).alias("_lang"), F.col(text_column).alias("_text"))

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "_text"):
                data, at = raw_text(part.column("_text"))
                codes, lengths, owner = windows(data, at)
                small = np.flatnonzero(np.diff(at) < SHORT)
                whole = np.zeros(part.num_rows, bool)
                whole[small] = [has_letter(t) for t in part.column("_text").take(pa.array(small, pa.int64())).to_pylist()]
                keep = np.flatnonzero((lengths >= SHORT) | whole[owner])
                own = owner[keep]
                # the first windows by waiting time are a draw without putting back; a document's windows share its rate
                place = np.uint64(1) + (np.arange(len(owner)) - np.searchsorted(owner, owner))[keep].astype(np.uint64)
                seed = part.column("_seed").to_numpy().view(np.uint64)[own]
                chance = (mix(seed ^ (place * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(11)).astype(float) / 2.0**53
                wait = -np.log1p(-chance) * np.bincount(own, minlength=part.num_rows)[own]
                langs = part.column("_lang").take(pa.array(own))
                yield pa.RecordBatch.from_arrays(
                    [langs, pa.array(lengths[keep]), pa.array([c.tobytes() for c in codes.T[keep]], pa.binary()), pa.array(wait)], ["lang", "n", "codes", "wait"]
                )

    cuts = texts.join(F.broadcast(chosen), ["_id", "_lang"]).select("_lang", "_text", F.xxhash64("_id", "_lang", "_text").alias("_seed"))
    cuts = cuts.mapInArrow(cut, "lang string, n long, codes binary, wait double")
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("wait", "codes"))
    sample = cuts.withColumn("turn", turn).filter(F.col("turn") <= draws).drop("turn", "wait").toPandas()
    if not len(sample):
        return None
    sample = sample.sort_values(["lang", "codes"], kind="stable")  # independent of the order of tasks
    languages = sorted(sample["lang"].unique())
    share = sample["lang"].map(sample["lang"].value_counts())
    rng = np.random.default_rng(1)  # every language is drawn equally often
    pick = rng.choice(len(sample), max(len(sample), 2000), p=(1 / share / len(languages)).to_numpy())
    codes = np.stack([np.frombuffer(c, np.uint8) for c in sample["codes"]]).T[:, pick]
    network = Network(languages)
    network.train(codes, sample["n"].to_numpy()[pick], np.searchsorted(languages, sample["lang"].to_numpy()[pick]), STEPS * rounds)
    return network


def predict(docs: DataFrame, network: Network | None, text_column: str = "text") -> DataFrame:
    """``[_row, lang_pred, score]`` for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(network)  # a few thousand weights
    rows, place, kind = carried(docs, text_column)

    def run(batches):
        model = sent.value
        for batch in batches:
            for part in slices(batch, place, 1 << 20):
                texts = text_in(part, place)
                lettered = np.array([has_letter(t) for t in texts.to_pylist()], bool)
                if model is None:
                    langs, scores = ["und"] * len(texts), np.zeros(len(texts))
                else:
                    pooled = model.pooled(*raw_text(texts))
                    best = pooled.argmax(axis=1)
                    langs = [model.languages[k] if ok else "und" for k, ok in zip(best, lettered)]
                    scores = np.where(lettered, np.clip(pooled[np.arange(len(best)), best], 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays([part.column("_row"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["_row", "lang_pred", "score"])

    return rows.mapInArrow(run, f"_row {kind}, lang_pred string, score double")
