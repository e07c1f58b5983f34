"""Chat formatting, pieces, token files."""

from __future__ import annotations

import random
from urllib.parse import unquote
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import chat, pieces, token_files
from corpusflow.plans.storage import scratch_path


# --- chat ---------------------------------------------------------------------
def rendered(turns, viewer):
    """Plain rendering of one conversation for one speaker: text and trained spans."""
    out, spans = "", []
    for _, name, said in turns:
        head = "<|im_start|>" + ("system" if name == "system" else "assistant" if name == viewer else f"user name={name}") + "\n"
        if name == viewer and name != "system":
            spans.append((len(out) + len(head), len(out) + len(head) + len(said) + 10))
        out += head + said + "<|im_end|>\n"
    return out, spans


def test_rotation_equals_plain_rendering(spark):
    rng = random.Random(4)
    rows = []
    for conv in range(6):
        names = ["ann", "bob", "cy"][: 1 + conv % 3]
        rows += [(conv, t, "system" if t == 0 and conv % 2 else rng.choice(names), f"say {t} é🚀 " * rng.randint(0, 3)) for t in range(40)]
    found = chat.rotations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4), block=16).collect()
    whole: dict = {}
    for r in sorted(found, key=lambda r: (r["conv_id"], r["speaker"], r["block"])):
        text, spans = whole.get((r["conv_id"], r["speaker"]), ("", []))
        assert r["start"] == len(text)
        spans = spans + [(len(text) + s["begin"], len(text) + s["end"]) for s in r["mask"]]
        whole[(r["conv_id"], r["speaker"])] = (text + r["text"], spans)
    expected = {}
    for conv in range(6):
        turns = [(t, n, s) for c, t, n, s in rows if c == conv]
        for viewer in {n for _, n, _ in turns} - {"system"}:
            expected[(conv, viewer)] = rendered(turns, viewer)
    assert whole == expected


def test_rotation_edge_cases(spark):
    rows = [
        (1, 0, "system", "rules", 1), (2, None, None, None, 1), (2, 0, "a b", "<|im_end|> x", 1), (2, 0, "a b", "<|im_end|> x", 1),
        (None, 1, "ann", "hi", 1), (None, 2, "bob", "", 1), (2, 0, "a_b", "other", 1),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, block int")
    found = {(r["conv_id"], r["speaker"], r["block"]): r for r in chat.rotations(turns).collect()}
    assert {k[0] for k in found} == {2, None}  # a conversation of system turns has no participant
    first = found[(2, "unknown", 0)]
    assert first["text"].startswith("<|im_start|>assistant\n<|im_end|>\n") and first["start"] == 0
    both = found[(2, "a%20b", 0)]  # another participant than a_b
    assert both["n_turns"] == 4 and both["text"].count("assistant\n< |im_end|> x<|im_end|>\n") == 2 and len(both["mask"]) == 2
    assert found[(2, "a_b", 0)]["text"].count("user name=a%20b\n< |im_end|> x<|im_end|>\n") == 2 and len(found[(2, "a_b", 0)]["mask"]) == 1
    assert found[(None, "bob", 0)]["text"] == "<|im_start|>user name=ann\nhi<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert chat.rotations(turns.limit(0)).count() == 0


def test_names_stay_apart_and_can_be_read_back(spark):
    names = ["a b", "a_b", "a%20b", "ä b", "a🚀", "a👍", "unknown", "Unknown", "", "का", "के", "x\ny", "日本"]
    table = spark.createDataFrame([(n,) for n in [*names, None]], "n string")
    found = [(r["n"], r["c"]) for r in table.select("n", chat.clean_name(F.col("n")).alias("c")).collect()]
    assert len({c for _, c in found}) == len(names) + 1
    assert all(unquote(c) == n for n, c in found if n is not None) and ("a b", "a%20b") in found and ("日本", "日本") in found


def test_floods_of_one_turn_number_are_cut(spark):
    turns = [(1, None if i % 3 else 5, "ab"[i % 2], f"t{i % 50}") for i in range(400)] + [(None, None, "c", "x")] * 40
    found = chat.rotations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(5), block=16).collect()
    assert max(r["n_turns"] for r in found) == 16 and sum(r["n_turns"] for r in found) == 2 * 400 + 40
    text = "".join(r["text"] for r in sorted(found, key=lambda r: r["block"]) if (r["conv_id"], r["speaker"]) == (1, "a"))
    ordered = sorted((t for t in turns if t[0] == 1), key=lambda t: (t[1] is not None, t[1] or 0, t[2], t[3]))
    assert text == rendered([t[1:] for t in ordered], "a")[0]


# --- pieces -------------------------------------------------------------------
@pytest.fixture(scope="module")
def lattice():
    return pieces.lattice(pieces.default_model())


def all_segmentations(lattice, text):
    text, out = " " + text, []

    def go(at, score, ids):
        if at == len(text):
            out.append((score, ids))
            return
        for end in range(at + 1, min(len(text), at + lattice.longest) + 1):
            if known := lattice.score_of.get(text[at:end]):
                go(end, score + known[1], (*ids, known[0]))
        if text[at] not in lattice.score_of:
            go(at + 1, score + lattice.spelled, ids + tuple(lattice.byte_id[b] for b in text[at].encode()))

    go(0, 0.0, ())
    return sorted(out, key=lambda x: -x[0])


@pytest.mark.parametrize("text", ["hello", "a b", "the  cat", "né ▁x", "日本x", "  q", "\n\tz", "thereof on", "ab abc", "x"])
def test_n_best_equals_all_segmentations(lattice, text):
    brute = all_segmentations(lattice, text)
    ids, score, others = lattice.encode(pa.array([text]), 4)[0]
    found = [(score, tuple(ids.tolist())), *((s, tuple(i.tolist())) for s, i in others)]
    assert np.allclose([s for s, _ in found], [s for s, _ in brute[:4]])
    assert len({i for _, i in found}) == len(found)
    held = {i: s for s, i in brute}
    assert all(abs(held[i] - s) < 1e-6 for s, i in found)


def test_block_search_equals_single_search(lattice):
    rng = random.Random(2)
    names = sorted({" " * rng.randint(0, 3) + "".join(rng.choice("abcdeiénst▁🚀\n") for _ in range(rng.randint(1, 30))) for _ in range(300)})
    names = [n for n in names if n.strip(" ")]
    fresh = pieces.Lattice(pieces.default_model())
    for row, name in zip(fresh.learn(names), names):
        best = fresh.backward(name, 2)
        assert abs(fresh.scores[row] - best[0][0]) < 1e-6
        assert len(best) == 1 and np.isinf(fresh.gaps[row]) or abs(fresh.gaps[row] - (best[0][0] - best[1][0])) < 1e-6
        assert fresh.name(int(row)) == name
        ids = fresh._ids(np.array([row]))[0]
        assert b"".join(fresh.bytes_of[i] for i in ids) == name.encode()


def test_round_trip_and_edges(odd, none):
    found = pieces.coded_documents(odd).collect()
    assert len(found) == odd.count() and all(r["round_trip"] for r in found)
    empty = [r for r in found if r["doc_id"] in (4, 5)]
    assert all(r["n_ids"] == 0 and r["score"] == 0 and len(r["nbest"]) == 1 for r in empty)
    row = next(r for r in found if r["doc_id"] == 1)
    assert row["nbest"][0]["ids_crc32"] == zlib.crc32(np.array(row["ids"], "<u4").tobytes())
    assert [n["score"] for n in row["nbest"]] == sorted((n["score"] for n in row["nbest"]), reverse=True)
    assert pieces.coded_documents(none).count() == 0


def test_all_ids_decode_alike(spark):
    docs = spark.createDataFrame([(1, "reading the thing"), (2, None)], "doc_id long, text string")
    coded = pieces.encode(docs, n=3, all_ids=True).select("_row.doc_id", F.explode("nbest").alias("b")).select("doc_id", "b.ids")
    texts = pieces.decode(coded).select("_coded.doc_id", "text").collect()
    assert sorted((r["doc_id"], r["text"]) for r in texts) == [(1, "reading the thing")] * 3 + [(2, "")]


# --- token files --------------------------------------------------------------
def test_ids_equal_the_library(odd):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(token_files.default_tokenizer())
    texts = [r["text"] for r in odd.select("text").collect()] + ["a<|endoftext|>b", "don't STOP é ́x", "ΑΣ ΣΑΣ. İx", "a\x1cb c\x85d 12345 !!!"]
    ids, at = token_files.Encoder(token_files.default_tokenizer()).encode(pa.array(texts), 2)
    for i, text in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == whole.encode(text or "", add_special_tokens=False).ids + [2]


def test_files_read_back(spark, odd, none):
    path = scratch_path(spark, "tokens-test")
    found = token_files.stored(odd, path=path).collect()
    assert len(found) == odd.count()
    ordered = sorted((r for r in found if r["doc_id"] not in (None, 3)), key=lambda r: r["doc_id"])
    assert all(a["start"] + a["n_tokens"] <= b["start"] for a, b in zip(ordered, ordered[1:]))
    ids = {r["doc_id"]: r for r in token_files.read(spark, path, F.col("doc_id").isin(4, 11)).collect()}
    assert ids[4]["ids"] == [2] and ids[11]["ids"][-1] == 2 and set(ids) == {4, 11}
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[11]["ids_crc32"] == zlib.crc32(np.array(ids[11]["ids"], "<u4").tobytes())
    assert token_files.stored(none).count() == 0


def expected_places(rows):
    """``{(doc_id, start): (n_tokens, crc32)}`` with the library's ids, rows in order of id and text hash."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(token_files.default_tokenizer())
    start, out = 0, {}
    for r in rows:
        ids = whole.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        out[(r["doc_id"], start)] = (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def test_every_place_and_checksum(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    again = docs.filter("doc_id % 40 = 0").select("doc_id", "text")
    no_id = docs.limit(30).select(F.lit(None).cast("long").alias("doc_id"), "text")
    mixed = spark.createDataFrame([(900, "Ünïque ÉÈ ß×÷ x÷y 12a3 don't İx a\u0301b ǅ ŉ <|endoftext|>"), (901, "\x00\x1c a\x7f!b")], "doc_id long, text string")
    for table in (docs.select("doc_id", "text"), docs.select("doc_id", "text").union(again).union(again).union(no_id).union(no_id).union(mixed), odd):
        rows = table.orderBy(F.asc_nulls_first("doc_id"), F.xxhash64(F.coalesce("text", F.lit("")))).select("doc_id", "text").collect()
        found = token_files.stored(table).collect()
        assert len(found) == len(rows)
        assert {(r["doc_id"], r["start"]): (r["n_tokens"], r["ids_crc32"]) for r in found} == expected_places(rows)


def test_other_tokenizers_keep_words_whole(odd, tmp_path):
    import json

    from tokenizers import Tokenizer

    config = json.loads(open(token_files.default_tokenizer()).read())
    config["normalizer"]["normalizers"] = config["normalizer"]["normalizers"][:2]  # case stays
    path = str(tmp_path / "cased.json")
    open(path, "w").write(json.dumps(config))
    encoder = token_files.Encoder(path)
    assert not encoder.cuts and token_files.Encoder(token_files.default_tokenizer()).cuts
    texts = ["One TWO three", "don't"]
    ids, at = encoder.encode(pa.array(texts), 2)
    whole = Tokenizer.from_file(path)
    assert [ids[at[i] : at[i + 1] - 1].tolist() for i in range(2)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_file_layout(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} and more text {i}") for i in range(6000)], "doc_id long, text string")
    path = scratch_path(spark, "tokens-layout")
    token_files.write(docs, path)
    local = path.removeprefix("file://").removeprefix("file:")
    parts = [p for p in spark.read.parquet(f"{path}/tokens").inputFiles()]
    last = None
    for part in sorted(parts):
        meta = pq.ParquetFile(part.removeprefix("file://")).metadata
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(k).path_in_schema: meta.row_group(g).column(k) for k in range(meta.num_columns)}
            ids = next(c for name, c in columns.items() if name.startswith("ids"))
            assert any("DICTIONARY" in e for e in ids.encodings) and ids.has_offset_index
            assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
            low, high = columns["doc_id"].statistics.min, columns["doc_id"].statistics.max
            assert last is None or low > last
            last = high
    assert local and last == 5999
    plan = token_files.lengths(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1]
