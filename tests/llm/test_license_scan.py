"""License scanning against plain phrase places and an edit-distance table."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from corpusflow.llm import license_scan, queries
from corpusflow.llm.license_scan import NOTICES, PHRASES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_base(words):
    places = [(i, label) for phrase, label in PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return len(at), min(at, default=None), max(at, default=None), {label for _, label in places}


def fewest_edits(notice, words):
    """Least edit distance between the notice and any run of whole words, by one table over the joined words."""
    text = " ".join(words)
    row = list(range(len(notice) + 1))  # a match may begin where a word does
    least = None
    for i, c in enumerate(text):
        before = row
        row = [0 if c == " " else before[0] + 1]
        row += [0] * len(notice)
        for j, n in enumerate(notice, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (c != n))
        if i + 1 == len(text) or text[i + 1] == " ":
            least = row[-1] if least is None else min(least, row[-1])
    return least


def noisy(rng, notice, edits):
    chars = list(notice)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            del chars[at]
        elif kind == 1:
            chars[at] = rng.choice("xyzé ")
        else:
            chars.insert(at, rng.choice("xyz🚀"))
    return "".join(chars)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    filler = "the a of license licence free software public domain all rights mit by cc und für 版权 x1 copy general".split()
    out = ["", "   ", None, "...", "CC-BY", "cc by cc by", "The MIT-License!", "omit licenses", "emit license", "MIT licence"]
    for i in range(260):
        words = [rng.choice(filler) for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            notice, _, edits = rng.choice(NOTICES)
            words.insert(rng.randint(0, len(words)), noisy(rng, notice, rng.randint(0, edits + 2)))
        joined = rng.choice([" ", "  ", "\n", ", "]).join(words)
        out.append(joined.upper() if i % 7 == 0 else joined)
    return out


def test_scan_equals_plain_search(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r["_row"]["doc_id"]: r for r in license_scan.scan(rows).collect()}
    seen = 0
    for i, text in enumerate(texts):
        words, r = plain_words(text), found[i]
        n, first, last, labels = plain_base(words)
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), n, first, last)
        assert {s["label"] for s in r["spans"] if s["base"]} == labels
        best = 1.0 if n else 0.0
        for notice, label, edits in NOTICES:
            least = fewest_edits(notice, words)
            if least is not None and least <= edits:
                labels.add(label)
                best = max(best, 1 - least / len(notice))
                seen += least > 0
        assert {s["label"] for s in r["spans"]} == labels, text
        assert r["score"] == pytest.approx(best)
        for s in r["spans"]:
            part = plain_words(text[s["begin"] : s["end"]])
            if s["base"]:
                assert (" ".join(part), s["label"]) in PHRASES
            else:
                assert any(label == s["label"] and fewest_edits(notice, part) <= s["edits"] <= edits for notice, label, edits in NOTICES)
    assert seen > 30


def test_pieces_leave_one_unchanged():
    rng = random.Random(3)
    for notice, _, edits in NOTICES:
        pieces = license_scan.cut_pieces(notice, edits)
        assert b"".join(p for _, p in pieces).decode() == notice and len(pieces) == edits + 1
        for _ in range(50):
            changed = noisy(rng, notice, edits)
            assert any(p.decode() in changed for _, p in pieces)


def test_long_repetition_stays_linear(spark):
    def seconds(times):
        rows = spark.createDataFrame([(1, "the mit licence " * times + "x" * times)], "doc_id long, text string")
        begin = time.perf_counter()
        row = license_scan.scan(rows).select("n_base", F.size("spans").alias("n")).first()
        assert (row["n_base"], row["n"]) == (0, times)
        return time.perf_counter() - begin

    seconds(10)
    assert seconds(20_000) < 40


def test_scan_edge_rows(odd, none, spark, tmp_path):
    assert license_scan.scan(none).count() == 0
    found = license_scan.scan(odd).select("_row.doc_id", "n_words", "n_base", "score", F.size("spans").alias("n")).collect()
    assert len(found) == odd.count() and all(r["score"] == 0 and r["n"] == 0 for r in found)
    assert {r["n_words"] for r in found if r["doc_id"] in (4, 5, 6)} == {0}
    odd.unionByName(odd.limit(1).withColumn("text", F.lit("MIT Licence, Apache License"))).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op13_license_notices(spark, str(tmp_path)).collect()
    assert len(rows) == odd.count() + 1
    hit = [r for r in rows if r["labels"]]
    assert [(r["base_labels"], r["labels"], r["score"]) for r in hit] == [("apache", "apache,mit", 1.0)]
