"""Token ids in binary files: static range asymmetric numerals over shared frequency tables.

1. Texts become ids in one pass; ids travel compressed to their range of document ids.
2. Frequencies of all ids give one table for all files, scaled to `2 ** SCALE`.
3. Each range is cut into blocks of whole documents. A block is coded by itself in up to
   `LANES` interleaved coders that share one stream of 32-bit words: step t codes ids
   t * lanes ... (t + 1) * lanes - 1, one each, as array operations.
4. A block holds its documents' ids and lengths, its place in the corpus, the final states,
   checkpoints (states and stream place every `CHECK` steps, so decoding may begin inside)
   and CRC-32 sums of its bytes and of its ids.

Blocks are rows of a Parquet table in ascending order of document ids, the frequency table is
another; Spark's writer commits them, so a lost executor costs its tasks only. Any block
can be decoded alone, by any task.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.session import durable, new_table_path

from .common import picked, size_of, text_slices
from .tokens import shared_tokenizer

SCALE = 18
LOW = 1 << 31  # states stay in [LOW, LOW << 32)
LANES, CHECK, BLOCK_IDS = 2048, 128, 1 << 19
RANGE_DOCS = 4000
_HEAD = struct.Struct("<4sIQQIIIIII")  # magic, lanes, ids, start, documents, words, checkpoints, body size, two sums
MAGIC = b"RIDS"


@dataclass
class Table:
    """Symbols in ascending order with frequencies that sum to 2 ** SCALE."""

    symbols: np.ndarray
    freq: np.ndarray

    def __post_init__(self):
        self.begin = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.freq = self.freq.astype(np.uint64)
        self._slots = self._numbers = None

    @property
    def numbers(self) -> np.ndarray:
        """The place of each symbol, by symbol."""
        if self._numbers is None:
            self._numbers = np.zeros(int(self.symbols.max(initial=0)) + 1, dtype=np.int32)
            self._numbers[self.symbols] = np.arange(len(self.symbols))
        return self._numbers

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._slots

    @classmethod
    def scaled(cls, symbols: np.ndarray, counts: np.ndarray) -> "Table":
        """Every symbol keeps a frequency of 1 or more; the sum is made right on the largest."""
        if len(symbols) > 1 << (SCALE - 1):
            raise ValueError("more symbols than the scale has room for")
        total = int(counts.sum())
        freq = np.maximum(1, np.array([int(c) * (1 << SCALE) // total for c in counts], dtype=np.int64))
        over = int(freq.sum()) - (1 << SCALE)
        for i in np.argsort(-freq, kind="stable"):
            if over == 0:
                break
            step = min(over, int(freq[i]) - 1) if over > 0 else over
            freq[i] -= step
            over -= step
        return cls(symbols, freq)


def encode(ids: np.ndarray, table: Table, lanes: int) -> tuple[np.ndarray, np.ndarray, list]:
    """(final states, words, checkpoints); a checkpoint is (step, place in the words, states)."""
    number = table.numbers[ids]
    freq, begin = table.freq[number], table.begin[number]
    steps = -(-len(ids) // lanes)
    state = np.full(lanes, LOW, dtype=np.uint64)
    chunks, marks = [], []
    top = np.uint64((LOW >> SCALE) << 32)
    emitted = 0
    for t in range(steps - 1, -1, -1):
        f, b = freq[t * lanes:(t + 1) * lanes], begin[t * lanes:(t + 1) * lanes]
        x = state[:len(f)]
        full = x >= top * f
        words = x[full]
        if len(words):
            chunks.append(words.astype(np.uint32))
            emitted += len(words)
            x[full] = words >> np.uint64(32)
        whole = x // f
        x[:] = (whole << np.uint64(SCALE)) + (x - whole * f) + b
        if t and t % CHECK == 0:
            marks.append((t, emitted, state.copy()))
    words = np.concatenate(chunks[::-1]) if chunks else np.zeros(0, np.uint32)
    return state, words, [(t, len(words) - e, s) for t, e, s in marks[::-1]]


def decode(n: int, state: np.ndarray, words: np.ndarray, table: Table, step: int = 0, place: int = 0) -> np.ndarray:
    """The ids from `step` on; `state` and `place` as they stand there."""
    lanes, state = len(state), state.copy()
    out = np.empty(max(0, n - step * lanes), dtype=np.uint32)
    slots, freq, begin = table.slots, table.freq, table.begin
    mask = np.uint64((1 << SCALE) - 1)
    for at in range(0, len(out), lanes):
        x = state[:min(lanes, len(out) - at)]
        slot = x & mask
        number = slots[slot]
        out[at:at + lanes] = number
        x[:] = freq[number] * (x >> np.uint64(SCALE)) + slot - begin[number]
        low = x < np.uint64(LOW)
        k = int(np.count_nonzero(low))
        if k:
            x[low] = (x[low] << np.uint64(32)) | words[place:place + k].astype(np.uint64)
            place += k
    return table.symbols[out]


def to_block(names: list, lengths: np.ndarray, ids: np.ndarray, start: int, table: Table) -> bytes:
    lanes = max(1, min(LANES, len(ids) // 64))
    state, words, marks = encode(ids, table, lanes)
    body = b"".join([
        np.array([0 if n is None else n for n in names], "<i8").tobytes(),
        np.array([n is None for n in names], "u1").tobytes(), lengths.astype("<u4").tobytes(),
        state.astype("<u8").tobytes(),
        *[struct.pack("<QQ", t, p) + s.astype("<u8").tobytes() for t, p, s in marks], words.astype("<u4").tobytes()])
    return _HEAD.pack(MAGIC, lanes, len(ids), start, len(names), len(words), len(marks), len(body),
                      zlib.crc32(body), zlib.crc32(ids.astype("<u4").tobytes())) + body


@dataclass
class Block:
    start: int
    names: list
    lengths: np.ndarray
    n: int
    state: np.ndarray
    marks: list
    words: np.ndarray
    ids_sum: int

    @classmethod
    def read(cls, data: bytes) -> "Block":
        magic, lanes, n, start, docs, words, marks, size, body_sum, ids_sum = _HEAD.unpack_from(data)
        body = data[_HEAD.size:]
        if magic != MAGIC or len(body) != size or zlib.crc32(body) != body_sum:
            raise ValueError("a damaged block")
        at = 0

        def take(kind, count):
            nonlocal at
            out = np.frombuffer(body, kind, count, at)
            at += out.nbytes
            return out

        names, none, lengths = take("<i8", docs), take("u1", docs), take("<u4", docs)
        state = take("<u8", lanes)
        found = []
        for _ in range(marks):
            t, p = take("<u8", 2)
            found.append((int(t), int(p), take("<u8", lanes)))
        return cls(start, [None if x else int(i) for i, x in zip(names, none)], lengths.astype(np.int64), n,
                   state.astype(np.uint64), found, take("<u4", words), ids_sum)

    def ids(self, table: Table, mark: int | None = None) -> np.ndarray:
        """All ids, checked; or those from a checkpoint on."""
        if mark is not None:
            step, place, state = self.marks[mark]
            return decode(self.n, state.astype(np.uint64), self.words, table, step, place)
        out = decode(self.n, self.state, self.words, table)
        if zlib.crc32(out.astype("<u4").tobytes()) != self.ids_sum:
            raise ValueError("ids do not match their sum")
        return out


# -- Spark ----------------------------------------------------------------------------------------

def _tokenised(batches, vocabulary, kind, end_id, bounds):
    encoder = shared_tokenizer(vocabulary.value, kind)
    end = np.array([end_id], dtype="<u4").tobytes()
    for frame in batches:
        texts = frame["text"].tolist()
        for a, b in text_slices(texts):
            none = frame["none"].to_numpy()[a:b]
            names = frame["id"].to_numpy()[a:b]
            ids = [x + end for x in encoder.encode(texts[a:b])]
            where = np.where(none, 0, np.searchsorted(bounds, names))
            rows = []
            for p in np.unique(where):
                own = np.flatnonzero(where == p)
                data = np.frombuffer(b"".join(ids[i] for i in own), "<u4")
                wide = "<u4" if data.max(initial=0) > 65535 else "<u2"
                parts = (names[own].astype("<i8").tobytes(), none[own].astype("u1").tobytes(),
                         np.array([len(ids[i]) // 4 for i in own], "<u4").tobytes(), data.astype(wide).tobytes())
                rows.append((int(p), len(own), len(data), wide == "<u4",
                             zstandard.compress(b"".join(parts), 1)))
            yield pd.DataFrame(rows, columns=["part", "docs", "n", "wide", "packed"])


def _unpacked(docs: int, wide: bool, packed: bytes):
    data = zstandard.decompress(packed)
    ids = np.frombuffer(data, "<u4" if wide else "<u2", offset=docs * 13)
    return (np.frombuffer(data, "<i8", docs), np.frombuffer(data, "u1", docs, docs * 8).astype(bool),
            np.frombuffer(data, "<u4", docs, docs * 9).astype(np.int64), ids)


def _frequencies(batches):
    total: dict[int, int] = {}
    for frame in batches:
        for docs, wide, packed in zip(frame["docs"], frame["wide"], frame["packed"]):
            counts = np.bincount(_unpacked(docs, wide, packed)[3])
            for i in np.flatnonzero(counts):
                total[int(i)] = total.get(int(i), 0) + int(counts[i])
    yield pd.DataFrame({"symbol": list(total), "count": list(total.values())}, dtype="int64")


def _encoded(frame: pd.DataFrame, table) -> pd.DataFrame:
    """One range in order of ids, as blocks."""
    parts = [_unpacked(*row) for row in zip(frame["docs"], frame["wide"], frame["packed"])]
    names, none, lengths = (np.concatenate([p[k] for p in parts]) for k in range(3))
    pieces = [x for p in parts for x in np.split(p[3], np.cumsum(p[2])[:-1])]
    order = sorted(range(len(names)), key=lambda i: (not none[i], names[i], lengths[i], pieces[i].tobytes()))
    start, rows, at = int(frame["base"].iloc[0]), [], 0
    while at < len(order):
        upto, size = at, 0
        while upto < len(order) and (upto == at or size + lengths[order[upto]] <= BLOCK_IDS):
            size += int(lengths[order[upto]])
            upto += 1
        own = order[at:upto]
        ids = np.concatenate([pieces[i] for i in own])
        rows.append((int(frame["part"].iloc[0]), len(rows), to_block(
            [None if none[i] else int(names[i]) for i in own], lengths[own], ids, start, table.value)))
        start += size
        at = upto
    return pd.DataFrame(rows, columns=["part", "number", "block"])


def _shared(spark: SparkSession, table_path: str):
    rows = spark.read.parquet(table_path).orderBy("symbol").collect()  # at most the vocabulary
    return spark.sparkContext.broadcast(Table(np.array([r["symbol"] for r in rows], dtype=np.int64),
                                              np.array([r["freq"] for r in rows], dtype=np.int64)))


def write_ids(docs: DataFrame, vocabulary: str, path: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = 0, kind: str = "byte", range_docs: int = RANGE_DOCS) -> str:
    """Write `path`/table and `path`/blocks.

    Documents come in ascending order of their (integer) id, those without one first, those
    that repeat one in order of length and ids. Null and empty texts are the end id alone.
    """
    spark = docs.sparkSession
    rows = picked(docs, id=id_col, text=text_col).select(
        F.coalesce(F.col("id").cast("bigint"), F.lit(0)).alias("id"), F.col("id").isNull().alias("none"),
        F.coalesce("text", F.lit("")).alias("text"))
    names = rows.where("not none").select("id")
    ranges = max(1, size_of(names) // range_docs)
    ends = names.repartitionByRange(ranges, "id").groupBy(F.spark_partition_id()).agg(F.max("id").alias("e")).collect()
    bounds = np.array(sorted(r["e"] for r in ends)[:-1], dtype=np.int64)  # a number per range
    shared = spark.sparkContext.broadcast(vocabulary)
    packed = durable(rows.mapInPandas(lambda b: _tokenised(b, shared, kind, end_id, bounds),
                                      "part int, docs int, n bigint, wide boolean, packed binary"))
    counts = packed.mapInPandas(_frequencies, "symbol bigint, count bigint").groupBy("symbol").agg(
        F.sum("count").alias("count")).orderBy("symbol").collect()  # at most the vocabulary
    if counts:
        scaled = Table.scaled(np.array([r["symbol"] for r in counts]), np.array([r["count"] for r in counts]))
        pairs = list(zip(scaled.symbols.tolist(), scaled.freq.astype(int).tolist()))
    else:
        pairs = []
    spark.createDataFrame(pairs, "symbol bigint, freq bigint").coalesce(1).write.parquet(f"{path}/table")
    table = _shared(spark, f"{path}/table")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow)  # one number per range
    bases = packed.groupBy("part").agg(F.sum("n").alias("held")).select(
        "part", (F.sum("held").over(before) - F.col("held")).alias("base"))
    blocks = packed.join(bases, "part").groupBy("part").applyInPandas(
        lambda frame: _encoded(frame, table), "part int, number int, block binary")
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    return path


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document, from the files: `id`, `start`, `n_tokens`, `ids_crc32`, and on demand `ids`
    (little-endian unsigned 32-bit numbers)."""
    table = _shared(spark, f"{path}/table")

    def documents(batches):
        for frame in batches:
            for data in frame["block"]:
                block = Block.read(data)
                ids = block.ids(table.value).astype("<u4")
                ends = np.cumsum(block.lengths)
                own = [ids[e - n:e].tobytes() for e, n in zip(ends, block.lengths)]
                out = pd.DataFrame({"id": pd.array(block.names, dtype="Int64"),
                                    "start": block.start + ends - block.lengths, "n_tokens": block.lengths,
                                    "ids_crc32": [zlib.crc32(x) for x in own]})
                yield out.assign(ids=own) if with_ids else out

    return spark.read.parquet(f"{path}/blocks").select("block").mapInPandas(
        documents, "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids)


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", **options) -> DataFrame:
    """Write all of `docs` to new files in the checkpoint folder and read them back."""
    path = write_ids(docs, vocabulary, new_table_path(docs.sparkSession), id_col, **options)
    return read_ids(docs.sparkSession, path).withColumnRenamed("id", id_col)
