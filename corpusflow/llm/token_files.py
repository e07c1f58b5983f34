"""Token ids in Parquet list columns that can be read selectively.

``write`` lays documents out by ranges of (doc_id, text), sorts each range and writes one file per range: ids as a dictionary-coded
list column, doc_id and lengths delta-coded (data page version 2), row groups and pages of a set size, with page
indexes. ``index`` adds where each document starts in the whole stream, from lengths alone. ``read`` takes ids
of some or all documents, ``lengths`` reads the metadata columns only; a filter on doc_id skips files, row
groups and pages by their bounds.

Ids come from the ``tokenizers`` library. Its normaliser and pre-tokeniser never look across ASCII white space, so words
are encoded once per task and kept in a bounded memory; the ids are those of the whole text. Where the file's own pre-tokeniser is the
known one, words of plain letters (ASCII and Latin-1), digits and marks are cut as it would cut them, in lower case, and
the memory holds those pieces, of which there are fewer. Other words, and words of other files, stay whole.

Edge cases: a null or empty text has the end id only. A null doc_id is written and sorts first. Rows that share a doc_id
follow each other by the hash of their text; rows equal in both have places of their own. An empty table gives an empty data set.
Other columns of the input are not written.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.storage import cut_lineage, scratch_path
from .common import Memo, list_rows, raw_text, run_hashes, shuffle_width, slices, word_bounds

END = 2
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000
MEMO = 1_000_000
JOINED = 256  # pieces the library gets in one text
_PIECE = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[!-&(-/:;=-@\[-`{-~]+")

# How the pre-tokeniser splits normalised text, for which pieces are cut here.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMAL = ["NFC", "Replace", "Lowercase"]
_GAP, _LETTER, _DIGIT, _MARK, _OTHER = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[33:127] = _MARK
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[[9, 10, 11, 12, 13, 32]] = _GAP
_CLASS[[ord("'"), ord("<")]] = _OTHER  # contractions and reserved tokens are left to the library
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _classes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class and lower-case form of every byte; two-byte letters from U+00C0 to U+00FF are letters."""
    kinds, lower = _CLASS[data], _LOWER[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    tail = data[lead + 1]
    letter = (tail >= 0x80) & (tail <= 0xBF) & (tail != 0x97) & (tail != 0xB7)
    lead, tail = lead[letter], tail[letter]
    kinds[lead] = kinds[lead + 1] = _LETTER
    lower[lead + 1] = np.where(tail <= 0x9E, tail + 32, tail)
    return kinds, lower


def cut_pieces(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes to read, and where pieces begin and end: words cut where the pre-tokeniser cuts them, words with other bytes whole."""
    kinds, lower = _classes(data)
    other = np.maximum.reduceat(kinds, begins) == _OTHER  # gaps up to the next word have the smallest class
    first = np.zeros(len(data), bool)
    first[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)
    first &= kinds != _GAP
    if other.any():
        edge = np.zeros(len(data) + 1, np.int8)
        edge[begins[other]] += 1
        edge[ends[other]] -= 1
        inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        first &= ~inside
        lower[inside] = data[inside]
    first[begins] = True
    starts = np.flatnonzero(first)
    stops = np.append(starts[1:], len(data))
    # the last piece of a word ends with it
    last = np.searchsorted(starts, begins[1:]) - 1
    stops[last], stops[-1] = ends[:-1], ends[-1]
    return lower, starts, stops


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _is_known(config: dict) -> bool:
    """Whether the file normalises and splits as ``cut_pieces`` does."""
    steps = [n["type"] for n in (config.get("normalizer") or {}).get("normalizers", [])]
    parts = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = [p for p in parts if p["type"] == "Split"]
    whole = [p for p in parts if p["type"] != "Split"]
    return (
        steps == NORMAL
        and [(p["pattern"].get("Regex"), p["behavior"], p["invert"]) for p in split] == [(SPLIT, "Removed", True)]
        and all(p["type"] == "ByteLevel" and not p["add_prefix_space"] and not p["use_regex"] for p in whole)
    )


class Encoder:
    """Ids of texts, word by word, with a bounded memory of words met before."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        config = json.loads(self.tokenizer.to_str())
        suffix = config["model"].get("end_of_word_suffix")
        self.cuts = bool(suffix) and _is_known(config)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.is_last = np.zeros(max(vocabulary.values()) + 1, bool)
        if self.cuts:
            self.is_last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._reset()

    def _reset(self) -> None:
        self.memo = Memo()
        self.pool = np.zeros(1 << 16, np.int32)
        self.ends = np.zeros(1 << 14, np.int64)
        self.count = 0

    def _ids(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all names end to end and the number of each, by the library."""
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(names, add_special_tokens=False)]
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        return np.fromiter(chain.from_iterable(encoded), np.int32, int(lengths.sum())), lengths

    def _ids_of_pieces(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces of one token run each: many go in one text, and a last token of a piece shows where it ends."""
        found, ends = self._ids([" ".join(names[i : i + JOINED]) for i in range(0, len(names), JOINED)])
        last = np.flatnonzero(self.is_last[found])
        if len(last) != len(names):
            return self._ids(names)
        return found, np.diff(last, prepend=-1)

    def _learn(self, names: list[str]) -> np.ndarray:
        plain = [n for n in names if _PIECE.fullmatch(n)] if self.cuts else []
        if len(plain) == len(names):
            ids, lengths = self._ids_of_pieces(names)
        else:
            is_plain = np.fromiter((bool(self.cuts and _PIECE.fullmatch(n)) for n in names), bool, len(names))
            parts = [self._ids_of_pieces(plain) if plain else self._ids([]), self._ids([n for n, p in zip(names, is_plain) if not p])]
            lengths = np.empty(len(names), np.int64)
            lengths[is_plain], lengths[~is_plain] = parts[0][1], parts[1][1]
            ids = np.empty(int(lengths.sum()), np.int32)
            kind = np.repeat(is_plain, lengths)
            ids[kind], ids[~kind] = parts[0][0], parts[1][0]
        base, total = int(self.ends[self.count - 1]) if self.count else 0, len(ids)
        while len(self.pool) < base + total:
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while len(self.ends) < self.count + len(names):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.pool[base : base + total] = ids
        self.ends[self.count : self.count + len(names)] = base + np.cumsum(lengths)
        self.count += len(names)
        return np.arange(self.count - len(names), self.count)

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each followed by ``end``, and the offsets of each."""
        if self.count > MEMO:
            self._reset()
        data, at = raw_text(texts)
        if not len(data):
            return np.full(len(texts), end, np.int32), np.arange(len(texts) + 1)
        begins, ends = word_bounds(data, at)
        if self.cuts and len(begins):
            data, begins, ends = cut_pieces(data, begins, ends)
        distinct, where, codes = np.unique(run_hashes(data, begins, ends), return_index=True, return_inverse=True)
        known = self.memo.find(distinct)
        fresh = np.flatnonzero(known < 0)
        if len(fresh):
            raw = data.tobytes()
            names = [raw[b:e].decode() for b, e in zip(begins[where[fresh]].tolist(), ends[where[fresh]].tolist())]
            known[fresh] = self._learn(names)
            self.memo.add(distinct[fresh], known[fresh])
        rows = known[codes]
        first = np.where(rows > 0, self.ends[rows - 1], 0)
        lengths = self.ends[rows] - first
        # ids of each text, then room for its end id
        stops = np.concatenate([[0], np.cumsum(lengths)])
        word_at = np.searchsorted(begins, at)
        per_text = np.diff(stops[word_at])
        offsets = np.concatenate([[0], np.cumsum(per_text + 1)])
        out = np.empty(offsets[-1], np.int32)
        out[offsets[1:] - 1] = end
        room = np.ones(len(out), bool)
        room[offsets[1:] - 1] = False
        out[room] = self.pool[np.arange(stops[-1]) + np.repeat(first - stops[:-1], lengths)]
        return out, offsets


_LOADED: dict[str, Encoder] = {}


def encode(rows: DataFrame, tokenizer: str | None = None, end: int = END) -> DataFrame:
    """``[doc_id, ord, text]`` to ``[doc_id, ord, n_tokens, ids]``, row order kept."""

    def run(batches):
        name = tokenizer or default_tokenizer()  # where the worker has it
        if name not in _LOADED:
            _LOADED[name] = Encoder(name)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, offsets = _LOADED[name].encode(part.column("text"), end)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ord"), pa.array(np.diff(offsets)), list_rows(ids, offsets, pa.int32())],
                    ["doc_id", "ord", "n_tokens", "ids"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ord", "text").mapInArrow(run, f"doc_id {kind}, ord long, n_tokens long, ids array<int>")


def _ranged(rows: DataFrame, parts: int) -> DataFrame:
    """Rows dealt to ``parts`` ranges of (doc_id, ord) by quantiles of the ids alone, so no text is read for the bounds.

    An id that fills several ranges is dealt to them by ``ord``.
    """
    number = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63)))
    shares = [F.lit(i / parts) for i in range(1, parts)]
    bounds = rows.agg(F.percentile_approx(number, F.array(*shares), F.lit(max(10_000, 10 * parts)))).first()[0] if shares else None
    if not bounds:
        return rows.coalesce(1)
    held = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    powers = F.array(*[F.lit(1 << b) for b in range(len(bounds).bit_length(), -1, -1)])

    def passed(beyond) -> Column:
        def narrow(low: Column, step: Column) -> Column:
            return F.when((low + step <= len(bounds)) & beyond(F.get("_bounds", low + step - 1)), low + step).otherwise(low)

        return F.aggregate(powers, F.lit(0), narrow)

    placed = rows.withColumns({"_number": number, "_bounds": held})
    placed = placed.withColumns({"_low": passed(lambda b: b < F.col("_number")), "_high": passed(lambda b: b <= F.col("_number"))})
    share = (F.col("ord").cast("double") + 2.0**63) / 2.0**64
    spread = F.least(F.floor(share * (F.col("_high") - F.col("_low") + 1)).cast("int"), F.col("_high") - F.col("_low"))
    return placed.repartitionById(parts, F.col("_low") + spread).select(*rows.columns)


def write(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", tokenizer: str | None = None, end: int = END) -> None:
    """Write ``path/tokens``: files in ascending (doc_id, ord) order, each sorted inside."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    rows = rows.withColumn("ord", F.xxhash64("text"))
    ranged = _ranged(rows, shuffle_width(docs.sparkSession)).sortWithinPartitions("doc_id", "ord")
    writer = encode(ranged, tokenizer, end).write.mode("overwrite")
    options = {
        "parquet.block.size": ROW_GROUP_BYTES,
        "parquet.page.size": PAGE_BYTES,
        "parquet.page.row.count.limit": PAGE_ROWS,
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#ids.list.element": "true",
        "parquet.dictionary.page.size": 1 << 20,
        "compression": "zstd",
    }
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.parquet(f"{path}/tokens")


def lengths(spark: SparkSession, path: str) -> DataFrame:
    """``[doc_id, ord, n_tokens]`` without touching the ids."""
    return spark.read.parquet(f"{path}/tokens").select("doc_id", "ord", "n_tokens")


def index(spark: SparkSession, path: str) -> None:
    """Write ``path/index``: ``[doc_id, ord, start]``, the place of the first such row in the stream of all ids.

    Rows are range-partitioned once; a running sum inside a range starts at the total of the ranges before it.
    """
    rows = lengths(spark, path)
    grouped = rows.groupBy("doc_id", "ord").agg(F.sum("n_tokens").alias("n"))  # equal rows follow each other
    keyed = grouped.repartitionByRange(shuffle_width(spark), "doc_id", "ord").withColumn("_part", F.spark_partition_id())
    keyed = cut_lineage(keyed)
    totals = sorted(keyed.groupBy("_part").agg(F.sum("n").alias("n")).collect())  # one row for each range
    ends = list(accumulate(r["n"] for r in totals))
    offsets = spark.createDataFrame([(r["_part"], end - r["n"]) for r, end in zip(totals, ends)], "_part int, _offset long")
    before = Window.partitionBy("_part").orderBy("doc_id", "ord").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.join(F.broadcast(offsets), "_part").withColumn("start", F.col("_offset") + F.coalesce(F.sum("n").over(before), F.lit(0)))
    placed.select("doc_id", "ord", "start").write.mode("overwrite").parquet(f"{path}/index")


def read(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """``[doc_id, ord, n_tokens, ids]``; ``where`` on doc_id is pushed down to row groups and pages."""
    rows = spark.read.parquet(f"{path}/tokens")
    return rows.filter(where) if where is not None else rows


def digests(rows: DataFrame) -> DataFrame:
    """``[doc_id, ord, n_tokens, ids_crc32]`` from the ids themselves, as little-endian 32-bit integers."""

    def run(batches):
        for batch in batches:
            column = batch.column("ids")
            values, at = column.values.to_numpy().astype("<u4"), column.offsets.to_numpy()
            sums = [zlib.crc32(values[i:j].tobytes()) for i, j in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ord"), pa.array(np.diff(at).astype(np.int64)), pa.array(sums, pa.int64())],
                ["doc_id", "ord", "n_tokens", "ids_crc32"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ord", "ids").mapInArrow(run, f"doc_id {kind}, ord long, n_tokens long, ids_crc32 long")


def stored(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizer: str | None = None, path: str | None = None) -> DataFrame:
    """Write, index and read back: ``[doc_id, start, n_tokens, ids_crc32]``, one row per document."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write(docs, path, id_column, text_column, tokenizer)
    index(spark, path)
    places = spark.read.parquet(f"{path}/index")
    found = digests(read(spark, path)).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.ord") == F.col("p.ord"))
    joined = found.join(places.alias("p"), same).select("d.doc_id", "d.ord", "p.start", "d.n_tokens", "d.ids_crc32")
    # copies of a row follow each other, each as long as the first
    copy = F.row_number().over(Window.partitionBy("doc_id", "ord").orderBy("n_tokens")) - 1
    return joined.select("doc_id", (F.col("start") + copy * F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32")
