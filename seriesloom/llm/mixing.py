"""Mixing sources to target weights in fixed-length blocks of words.

1. The words of each source form one stream, cut into blocks of `block` words
   (the last may be shorter). Offsets come from sums over slices of a source, of
   which there are about as many as rows in a slice, so that no task holds a source.
2. A source's target is turned into a number of slots, one block each. The slots
   are dealt over output shards of `shard_slots` slots: the counts of the sources
   in a shard are multinomial draws conditioned on every source's total. They are
   drawn down a binary tree over the shards (each node splits its parent's counts
   hypergeometrically with a seed of its own), so any task can work out any shard
   alone and reruns agree.
3. The k-th slot of a source takes block `permutation(k mod n)` of its n blocks,
   with another keyed permutation in each pass, so blocks repeat only after all
   have been used.
4. Slots and blocks are joined by (source, block).
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.functions.columns import q
from seriesloom.session import durable

from .common import WORD, picked, size_of

WEIGHTS = (5.0, 2.0, 1.0)  # by the order of the source names, repeating
MAX_PASSES = 3


def targets(sizes: list[int], weights: list[float], share: float = 1.0,
            most: float = MAX_PASSES) -> list[float]:
    """Split `share` of all sizes by weight; what exceeds `most` times a source's size
    goes to the others by weight, until none is above."""
    total, out, open_ = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in open_)
        weight = sum(weights[i] for i in open_)
        for i in open_:
            out[i] = left * weights[i] / weight if weight else 0.0
        above = {i for i in open_ if out[i] > most * sizes[i]}
        for i in above:
            out[i] = float(most * sizes[i])
        if not above:
            break
        open_ -= above
    return out


def _seeded(*parts) -> np.random.Generator:
    digest = hashlib.blake2b(repr(parts).encode(), digest_size=16).digest()
    return np.random.Generator(np.random.PCG64(int.from_bytes(digest, "little")))


def _split(counts: np.ndarray, take: int, rng: np.random.Generator) -> np.ndarray:
    """How many of each source's slots are among `take` slots drawn without return."""
    out, rest = np.zeros_like(counts), int(counts.sum())
    for i, have in enumerate(counts.tolist()):
        rest -= have
        if take == 0 or have == 0:
            continue
        low, high = max(0, take - rest), min(have, take)
        if have + rest < 10**9:  # the exact generator's range
            n = int(rng.hypergeometric(have, rest, take))
        else:  # its normal limit
            p, whole = have / (have + rest), have + rest
            n = round(rng.normal(take * p, math.sqrt(take * p * (1 - p) * (whole - take) / (whole - 1))))
        n = min(max(n, low), high)
        out[i], take = n, take - n
    return out


class Shards:
    """Source counts of every shard and of all shards before it."""

    def __init__(self, quotas: list[int], shard_slots: int, seed: int):
        self.quotas, self.slots, self.seed = np.array(quotas, dtype=np.int64), shard_slots, seed
        self.total = int(self.quotas.sum())
        self.n = -(-self.total // shard_slots)
        self._known: dict = {}

    def _slots_of(self, low: int, high: int) -> int:
        return min(high * self.slots, self.total) - low * self.slots

    def counts(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        low, high, own = 0, self.n, self.quotas
        before = np.zeros_like(own)
        while high - low > 1:
            middle = (low + high) // 2
            left = self._known.get((low, high))
            if left is None:
                if len(self._known) > 4096:
                    self._known.clear()
                left = _split(own, self._slots_of(low, middle), _seeded(self.seed, low, high))
                self._known[(low, high)] = left
            if shard < middle:
                high, own = middle, left
            else:
                low, own, before = middle, own - left, before + left
        return own, before


def permute(index: np.ndarray, n: int, *key) -> np.ndarray:
    """A keyed permutation of range(n) applied to `index`: four Feistel rounds, walking
    on where the power-of-four domain is left."""
    if n <= 1:
        return np.zeros_like(index)
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = _seeded("permutation", *key).integers(1, 2**62, size=4, dtype=np.uint64)
    out = index.astype(np.uint64)
    todo = np.ones(len(out), dtype=bool)
    while todo.any():
        x = out[todo]
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo[todo] = out[todo] >= n
    return out.astype(np.int64)


def _drawn(batches, shards: Shards, blocks: list[int], seed: int):
    for frame in batches:
        for shard in frame["id"]:
            own, before = shards.counts(int(shard))
            which = np.repeat(np.arange(len(own)), own)
            _seeded(seed, "order", int(shard)).shuffle(which)
            passes, block = np.zeros(len(which), np.int64), np.zeros(len(which), np.int64)
            for i in np.flatnonzero(own):
                k = np.arange(before[i], before[i] + own[i])
                at, lap = which == i, k // blocks[i]
                done = np.empty_like(k)
                for one in np.unique(lap):
                    same = lap == one
                    done[same] = permute(k[same] % blocks[i], blocks[i], seed, int(i), int(one))
                passes[at], block[at] = lap, done
            yield pd.DataFrame({"shard": int(shard), "slot": np.arange(len(which)), "src": which,
                                "pass": passes, "block": block})


class Mix:
    """The parts of a mix: `sources`, `rows` (one per input row) and `pieces`."""

    def __init__(self, sources: list[dict], rows: DataFrame, pieces: DataFrame):
        self.sources, self.rows, self.pieces = sources, rows, pieces


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = 1.0, most: int = MAX_PASSES, block: int = 128,
        shard_slots: int = 1024, seed: int = 20) -> Mix:
    """Draw a mix of all rows.

    `pieces` has a row per part of a document that a slot takes: `shard`, `slot`,
    `pass`, `src`, `row` (the place of the document in its source's stream), `start`
    and `length` in words. `rows` has `id`, `digest` of the text, `src`, `row`, `size`.

    Null and empty texts have size 0 and are never taken; a null source is one
    source, the last. Rows that repeat an id are rows of their own. Sources are
    collected, one short record each: a mix names its sources. An empty table, or
    one without words, gives no pieces.
    """
    text = F.col("text")
    sized = durable(picked(docs, id=id_col, text=text_col, source=source_col).select(
        "id", "source", F.xxhash64(text).alias("digest"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size")))
    found = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    wanted = targets([r["size"] for r in found], [weights[i % len(weights)] for i in range(len(found))],
                     share, most)
    blocks = [-(-r["size"] // block) for r in found]
    sources = [{"src": i, "source": r["source"], "source_size": r["size"], "target": wanted[i],
                "slices": math.isqrt(r["n"]) + 1, "blocks": blocks[i],
                "slots": min(most * blocks[i], round(wanted[i] * blocks[i] / max(r["size"], 1)))}
               for i, r in enumerate(found)]
    spark = docs.sparkSession
    table = spark.createDataFrame(
        [(s["src"], s["source"], s["slices"]) for s in sources], "src int, source string, slices int")
    parted = sized.join(F.broadcast(table), sized["source"].eqNullSafe(table["source"])).select(
        "id", "digest", "src", "size", F.pmod(F.xxhash64("id", "digest"), F.col("slices")).alias("slice"))
    inside = W.partitionBy("src", "slice").orderBy("id", "digest").rowsBetween(W.unboundedPreceding, W.currentRow)
    heads = parted.groupBy("src", "slice").agg(F.sum("size").alias("held"))
    before = W.partitionBy("src").orderBy("slice").rowsBetween(W.unboundedPreceding, W.currentRow)
    heads = heads.select("src", "slice", (F.sum("held").over(before) - F.col("held")).alias("base"))
    rows = durable(parted.withColumn("_in", F.sum("size").over(inside) - F.col("size"))
                   .join(heads, ["src", "slice"])
                   .select("id", "digest", "src", "size", (F.col("base") + F.col("_in")).alias("row")))
    first, last = F.col("row"), F.col("row") + F.col("size")
    spans = rows.where("size > 0").select(
        "src", "row", "size",
        F.explode(F.expr(f"sequence(row div {block}, (row + size - 1) div {block})")).alias("block")).select(
        "src", "block", "row",
        (F.greatest(F.col("block") * block, first) - first).alias("start"),
        (F.least((F.col("block") + 1) * block, last) - F.greatest(F.col("block") * block, first)).alias("length"))
    shards = Shards([s["slots"] for s in sources], shard_slots, seed)
    slots = spark.range(0, shards.n).mapInPandas(
        lambda batches: _drawn(batches, shards, blocks, seed),
        "shard bigint, slot int, src int, pass int, block bigint")
    # what the range makes is far larger than the range: never broadcast it
    return Mix(sources, rows, slots.hint("merge").join(spans, ["src", "block"]))


def taken(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per row: the id, `size`, `source_size`, `target`, `taken`."""
    drawn = mix(docs, id_col, **options)
    sums = drawn.pieces.groupBy("src", "row").agg(F.sum("length").alias("taken"))
    table = docs.sparkSession.createDataFrame(
        [(s["src"], s["source_size"], float(s["target"])) for s in drawn.sources],
        "src int, source_size bigint, target double")
    # rows without words share their place with the next row and take nothing
    found = drawn.rows.join(sums.withColumn("_some", F.lit(True)),
                            (drawn.rows["src"] == sums["src"]) & (drawn.rows["row"] == sums["row"])
                            & (drawn.rows["size"] > 0), "left").select(drawn.rows["*"], "taken")
    return found.join(F.broadcast(table), "src").select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", **options) -> DataFrame:
    """The mixed corpus with the columns of `docs`: a row per document and pass, whose text
    is what the pass takes of it.

    A text taken whole stays as it is; of others the taken words are joined by one
    space. Documents of which nothing is taken are left out.
    """
    drawn = mix(docs, id_col, text_col, source_col, **options)
    runs = drawn.pieces.groupBy("src", "row", "pass").agg(
        F.array_sort(F.collect_list(F.struct("start", "length"))).alias("_runs"),  # parts of one text
        F.sum("length").alias("_taken"))
    named = drawn.rows.where("size > 0").join(runs, ["src", "row"]).select(
        F.col("id").alias("_id"), F.col("digest").alias("_digest"), F.col("size").alias("_size"), "_runs", "_taken")
    digest = F.xxhash64(F.col(q(text_col)))
    marked = docs.withColumn("_own", digest)
    if not drawn.rows.groupBy("id", "digest").count().where("count > 1").isEmpty():
        marked = marked.dropDuplicates([id_col, "_own"])  # repeated rows each have their runs
    words = F.regexp_extract_all(F.col(q(text_col)), F.lit(WORD), F.lit(0))
    parts = F.flatten(F.transform("_runs", lambda r: F.slice(F.col("_words"), r["start"].cast("int") + 1,
                                                               r["length"].cast("int"))))
    joined = marked.join(named, marked[q(id_col)].eqNullSafe(named["_id"]) & (F.col("_own") == F.col("_digest")))
    cut = joined.withColumn("_words", F.when(F.col("_taken") < F.col("_size"), words)).withColumn(
        text_col, F.when(F.col("_taken") == F.col("_size"), F.col(q(text_col))).otherwise(F.array_join(parts, " ")))
    return cut.select(*[F.col(q(c)) for c in docs.columns])
