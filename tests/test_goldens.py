"""Known results: losses, comparison table, formats, masks."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import arrays as ar
from corpusflow.functions import text as tx
from corpusflow.operators import batching as bt
from corpusflow.operators import evals as ev
from corpusflow.operators import policy as po
from corpusflow.operators import rewards as rw
from corpusflow.operators import sequences as sq

# --- fixed values: published scores per prompt (sft, ppo, grpo, dpo) and their averages ---
SCORES = [
    (6.7678, 5.3858, -1.2272, 5.4389),
    (4.0546, 3.3365, -5.9703, 6.9269),
    (0.42, 5.9481, -7.2526, -6.6323),
    (3.8321, 5.5825, -3.2658, -7.7453),
    (-3.9246, 1.9903, -2.1793, 0.2466),
    (6.4289, 8.0739, 4.1202, 3.9406),
    (7.0385, -4.9277, 4.1609, 6.1398),
    (0.8684, 8.0507, 6.3669, 1.6736),
    (6.2655, 6.2655, -0.7734, 2.9658),
    (1.8458, 7.4686, 5.9181, 6.988),
    (6.4924, 5.775, -2.6316, 7.1311),
    (-7.1005, -7.1005, 0.0125, 4.9053),
    (7.438, -1.2132, -5.1353, -4.2775),
    (0.5945, 6.9572, 1.5476, -4.9127),
    (7.0149, 7.0149, 4.9857, 7.8384),
    (0.1083, 5.2684, -0.5306, 7.8231),
]
AVERAGES = {"sft": 3.009, "ppo": 3.9923, "grpo": -0.1159, "dpo": 2.4031}
# ------------------------------------------------------------------------------------------


def _table(spark, rows=SCORES):
    return spark.createDataFrame([(f"p{i:02d}", *r) for i, r in enumerate(rows)], "prompt string, sft double, ppo double, grpo double, dpo double")


def test_published_averages_and_winner(spark):
    averages = ev.method_averages(_table(spark))
    assert averages.first().asDict() == AVERAGES
    assert ev.overall_winner(averages).first()["method"] == "ppo"


def test_winner_ties_go_to_the_earlier_method(spark):
    rows = [(1.0, 1.0, 0.0, None), (None, None, 2.0, 2.0), (None, None, None, None)]
    got = [r["winner"] for r in ev.winner(_table(spark, rows)).orderBy("prompt").collect()]
    assert got == ["sft", "grpo", None]


def test_averages_divide_by_all_rows_unless_asked(spark):
    table = _table(spark, [(1.0, 2.0, None, None), (3.0, None, None, None)])
    assert ev.method_averages(table).first().asDict() == {"sft": 2.0, "ppo": 1.0, "grpo": None, "dpo": None}
    assert ev.method_averages(table, null_safe=True).first()["ppo"] == 2.0


def test_zero_score_counts_as_missing(spark):
    table = _table(spark, [(0.5, 0.0, 1.0, 1.0), (0.5, -1.0, 1.0, 1.0), (9.0, 9.5, 1.0, 1.0)])
    worst = {r["method"]: r["prompt"] for r in ev.worst_prompt(table).collect()}
    assert worst["ppo"] == "p01"
    best = {r["method"]: r for r in ev.best_delta(table).collect()}
    assert best["ppo"]["prompt"] == "p02" and best["grpo"]["prompt"] == "p00"
    low = _table(spark, [(-5.0, 0.0, 1.0, 1.0), (0.5, 1.0, 1.0, 1.0)])
    assert {r["method"]: r["prompt"] for r in ev.best_delta(low).collect()}["ppo"] == "p01"
    assert {r["method"]: r["prompt"] for r in ev.best_delta(low, zero_is_missing=False).collect()}["ppo"] == "p00"


def test_duplicate_prompt_last_wins_and_left_join(spark):
    rows = [("a", "sft", 1.0, 1), ("a", "sft", None, 2), ("a", "ppo", 3.0, 3), ("b", "ppo", 4.0, 4)]
    got = ev.comparison_table(spark.createDataFrame(rows, "prompt string, method string, reward double, o int"), "o").collect()
    assert [tuple(r) for r in got] == [("a", None, 3.0, None, None)]


def test_clipped_policy_losses(spark):
    row = dict(new_logp=math.log(1.2), old_logp=0.0, adv=1.0, new_value=1.0, ret=0.0, ref_logp=math.log(1.2) - 0.5)
    df = spark.createDataFrame([row] * 32)
    ppo = po.ppo_losses(df, 0.1, 0.5, 0.0).first()
    assert ppo["policy_loss"] == pytest.approx(-1.1) and ppo["value_loss"] == 1.0 and ppo["total_loss"] == pytest.approx(-0.6)
    grpo = po.grpo_losses(df, 0.1, 0.0, 0.1, reference_sign=True).first()
    assert grpo["policy_loss"] == pytest.approx(1.1) and grpo["total_loss"] == pytest.approx(1.15)
    assert po.grpo_losses(df, 0.1, 0.0, 0.1).first()["total_loss"] == pytest.approx(-1.05)
    assert list(po.grpo_losses(df.limit(0)).first()) == [0.0] * 5


@pytest.mark.parametrize(
    "pc, pr, acc, margin", [(-1.0, -5.0, 1.0, 4.0), (-5.0, -1.0, 0.0, -4.0), (-3.0, -3.0, 0.0, 0.0), (-900.0, 0.0, 0.0, -900.0)]
)
def test_preference_loss(spark, pc, pr, acc, margin):
    out = po.dpo_loss(spark.createDataFrame([(pc, pr, -3.0, -3.0)], "pc double, pr double, rc double, rr double"), 1.0).first()
    assert (out["accuracy"], out["reward_margin"]) == (acc, margin)
    assert out["loss"] == pytest.approx(math.log1p(math.exp(-margin)) if margin > -700 else -margin)


def test_ranking_losses_fall_with_the_margin(spark):
    def losses(shift):
        df = spark.createDataFrame([(2.0 + shift, 1.0), (3.0 + shift, 1.5)], "r_pos double, r_neg double")
        return rw.bradley_terry_loss(df).first()[0], rw.margin_ranking_loss(df, 2.0).first()[0], rw.pair_accuracy(df).first()[0]

    near, far = losses(0.0), losses(1.0)
    assert far[0] < near[0] and far[1] < near[1] and near[2] == far[2] == 1.0
    empty = spark.createDataFrame([], "r_pos double, r_neg double")
    assert tuple(rw.pair_accuracy(empty).first()) == (0.0, 0)


def test_group_modes_and_group_of_one(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 2, 4.0), (2, 3, 5.0), (3, 4, 1.0), (3, 5, 1.0)], "prompt_id int, id int, reward double")
    def adv(mode):
        return {r["id"]: r["adv"] for r in po.group_advantage(df, mode, salt_by=("id",)).collect()}

    assert adv("center") == {1: -1.0, 2: 1.0, 3: 0.0, 4: 0.0, 5: 0.0}
    assert adv("clamp")[2] == pytest.approx(1 / math.sqrt(2)) and adv("clamp")[3] is None and adv("clamp")[4] == 0.0
    assert adv("eps")[2] == pytest.approx(1 / (math.sqrt(2) + 1e-6)) and adv("eps")[3] is None
    same = df.withColumn("response", F.lit("x"))
    assert [tuple(r) for r in po.collapsed_groups(same).collect()] == [(3, 2, 1, 0.0)]


def test_template_and_prompt_suffix(spark):
    df = spark.createDataFrame([("Say hi ", "Hello!\n"), ("a</s>b", "x")], "i string, r string")
    full, prompt = df.select(tx.format_example("i", "r"), tx.format_prompt("i")).first()
    assert full == "<s>\n### Instruction:\nSay hi\n\n### Response:\nHello!</s>"
    assert prompt.endswith("### Response:\n") and "</s>" not in prompt
    assert "ab" in df.filter("r = 'x'").select(tx.format_prompt("i")).first()[0]


def test_sft_mask_exact(spark):
    rows = [("This is a tiny test.", "OK"), ("p" * 300, "never reached"), ("x", "")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, prompt string, response string")
    for r in sq.sft_collate(df, 256).orderBy("id").collect():
        prompt, response = rows[r["id"]]
        head = f"<s>\n### Instruction:\n{prompt}\n\n### Response:\n".encode()
        text = (head + response.encode() + b"</s>")[:256]
        n = min(len(head), 256, len(text))
        labels = [-100 if t < n - 1 else text[t + 1] for t in range(len(text) - 1)] + [-100]
        assert r["ids"] == list(text) + [2] * (256 - len(text))
        assert r["labels"] == labels + [-100] * (256 - len(labels))


@pytest.mark.parametrize("n_prompt, n_response", [(3, 4), (10, 4), (0, 3), (5, 8), (5, 20), (9, 0)])
def test_response_mask_pairs(spark, n_prompt, n_response):
    size = 8
    prompt, response = list(range(100, 100 + n_prompt)), list(range(n_response))
    df = spark.createDataFrame([(1, prompt, response)], "id int, prompt_ids array<int>, response_ids array<int>")
    out = sq.build_pair(df, size).first()
    kept = response[: size - 1] if n_response >= size else response
    full = (prompt[max(0, n_prompt + len(kept) - size) :] + kept)[:size]
    assert out["ids"] == full and out["resp_mask"] == [i >= len(full) - len(kept) for i in range(len(full))]


def test_small_arrays(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],)], "a array<int>")
    got = df.select(ar.shift_labels("a"), ar.pad_to("a", 5, 2), ar.pad_to("a", 2, 2), ar.tail("a", 2)).collect()
    assert [list(r) for r in got] == [[[2, 3, -100], [1, 2, 3, 2, 2], [1, 2], [2, 3]], [[], [2] * 5, [2, 2], []]]


def test_blocks_cross_documents_and_shift_by_one(spark):
    texts = ["abcdefg", "", "h", "ijklmnopqrstuvwxyz", "é"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    at = sq.global_positions(docs, "doc_id", F.octet_length("text"))
    placed = docs.join(at, "doc_id").select(tx.byte_ids("text").alias("ids"), "start")
    stream = list("".join(texts).encode())
    total = sq.token_total(docs, F.octet_length("text"))
    for size, stride in [(3, 1), (5, 2), (4, 7)]:
        got = {r["block_id"]: (r["x"], r["y"]) for r in sq.blocks(placed, size, total, stride).collect()}
        starts = range(0, len(stream) - size - 1, stride)
        assert got == {s // stride: (stream[s : s + size], stream[s + 1 : s + size + 1]) for s in starts}
    for r in sq.sample_blocks(placed, 20, 4, 1, total).collect():
        assert r["x"][1:] == r["y"][:-1] and bytes(r["x"]) in bytes(stream)
    short = docs.filter("doc_id = 2")
    tiny = short.select(tx.byte_ids("text").alias("ids"), F.lit(0).cast("bigint").alias("start"))
    assert sq.blocks(tiny, 3, sq.token_total(short, F.octet_length("text"))).count() == 0


def test_modulus_batches_repeat_the_front_when_the_end_wraps(spark):
    df = spark.range(16).withColumnRenamed("id", "k")
    got = {}
    for r in bt.mod_batches(df, 8, 3, "k").collect():
        got.setdefault(r["step"], {})[r["slot"]] = r["k"]
    assert [list(dict(sorted(got[s].items())).values()) for s in range(3)] == [list(range(8)), list(range(8)), list(range(8))]
    cyc = [(r["step"], r["slot"], r["k"]) for r in bt.cyclic_batches(spark.range(5).withColumnRenamed("id", "k"), 2, 4, "k").orderBy("step", "slot").collect()]
    assert cyc == [(0, 0, 0), (0, 1, 1), (1, 0, 2), (1, 1, 3), (2, 0, 4), (3, 0, 0), (3, 1, 1)]


def test_f1_edges(spark):
    rows = [(1, "a b b", "b b c"), (2, "", "!!"), (3, "x", ""), (4, "The cat", "the CAT!")]
    out = {r["id"]: r["f1"] for r in ev.token_f1(spark.createDataFrame(rows, "id int, p string, g string"), "id", "p", "g").collect()}
    assert out == {1: pytest.approx(2 / 3), 2: 1.0, 3: 0.0, 4: 1.0}
