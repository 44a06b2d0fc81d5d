"""Near duplicates by circulant MinHash.

Two permutations give a whole signature. The first scatters the shingles over positions
0 .. 2^32 - 1; the second, shifted by k places around that ring, gives coordinate k: the
smallest value at any of the set's positions. So a signature of any length needs one
permutation of the shingles and one function, and nothing is stored for a coordinate.

1. The distinct `width`-word shingles of each text; equal sets are one set from here on.
2. BANDS bands of ROWS coordinates each. Sets alike in a band are candidates: at the
   similarity of 0.85 a pair is missed by all bands with a chance of (1 - 0.85^6)^40 < 10^-8.
3. Every set with a candidate lies in one block: that of the most frequent band near it, cut by hash
   into blocks of about BLOCK_SHINGLES shingles. A block's sets are compared with each other on their
   full sets of shingles; those connected already are not compared again.
4. Bands that still join different components name the pairs of blocks left to compare. So a group
   of m sets ships each set once per block of the group: no pair of sets is ever a row, but
   for those that are linked.
5. Components of the verified links.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.operators.graph import connected_components
from seriesloom.session import durable

from .common import picked, text_slices
from .ngram_join import fingerprint, shingle_sets

WIDTH = 3
SIMILAR = 85  # 100 * intersection >= 85 * union
BANDS, ROWS = 40, 6
BLOCK_SHINGLES = 1 << 18  # of the sets compared with each other in one task
PIECE = 1 << 16  # shingles permuted together


# -- signatures -----------------------------------------------------------------------------------

def _scattered(shingles: np.ndarray) -> np.ndarray:
    """The first permutation: 64-bit hashes to positions on the ring."""
    x = shingles * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)).astype(np.uint32)


def _ring(x: np.ndarray) -> np.ndarray:
    """The second permutation of 0 .. 2^32 - 1 (each step is one to one), in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray], coordinates: int = BANDS * ROWS) -> np.ndarray:
    """(set, coordinate) smallest values of the second permutation, shifted by the coordinate."""
    out = np.full((len(sets), coordinates), 2**32 - 1, dtype=np.uint32)
    sizes = np.array([len(s) for s in sets])
    # pieces of about PIECE shingles; a longer set is cut and its minima are merged
    start = 0
    while start < len(sets):
        end, held = start, 0
        while end < len(sets) and (end == start or held + sizes[end] <= PIECE):
            held += sizes[end]
            end += 1
        full = [i for i in range(start, end) if sizes[i]]
        if full:
            places = _scattered(np.concatenate([sets[i] for i in full]))
            for a in range(0, len(places), PIECE) if len(full) == 1 else (0,):
                part = places[a:a + PIECE] if len(full) == 1 else places
                begins = np.concatenate([[0], np.cumsum(sizes[full])[:-1]]) if len(full) > 1 else np.zeros(1, int)
                for k in range(coordinates):
                    least = np.minimum.reduceat(_ring(part + np.uint32(k)), begins)
                    out[full, k] = np.minimum(out[full, k], least)
        start = end
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(set, band) 64-bit keys; a key holds its band's number."""
    n, coordinates = signature.shape
    bands = coordinates // ROWS
    keys = np.zeros((n, bands), dtype=np.uint64)
    for r in range(ROWS):
        keys = (keys ^ signature[:, r:bands * ROWS:ROWS]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return (keys + np.arange(bands, dtype=np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)


def _measured(batches, width):
    for frame in batches:
        texts = frame["text"].tolist()
        for a, b in text_slices(texts):
            sets = shingle_sets(texts[a:b], width)
            marks = [fingerprint(s) if len(s) else (None, None) for s in sets]
            # a copy within the slice needs no signature of its own
            first: dict = {}
            for i, m in enumerate(marks):
                first.setdefault(m, i)
            own = sorted(i for m, i in first.items() if m[0] is not None)
            keys = dict(zip(own, band_keys(signatures([sets[i] for i in own]))))
            yield pd.DataFrame({"id": frame["id"].iloc[a:b].to_numpy(), "digest": frame["digest"].iloc[a:b].to_numpy(),
                                "n": [len(s) for s in sets],
                                "a": pd.array([m[0] for m in marks], dtype="Int64"),
                                "b": pd.array([m[1] for m in marks], dtype="Int64"),
                                "bands": [keys[i].tobytes() if i in keys else None for i in range(b - a)]})


def _posted(batches):
    for frame in batches:
        keys = [np.frombuffer(k, "<i8") for k in frame["bands"]]
        yield pd.DataFrame({"band": np.concatenate([*keys, np.zeros(0, np.int64)]),
                            "set": np.repeat(frame["set"].to_numpy(), [len(k) for k in keys])})


def _shingled(batches, width):
    """(set, shingles) of the texts that stand for a set; a text with the digest of another has its own mark."""
    for frame in batches:
        texts, marks = frame["text"].tolist(), list(zip(frame["a"], frame["b"]))
        for a, b in text_slices(texts):
            sets = shingle_sets(texts[a:b], width)
            own = [i for i, s in enumerate(sets) if fingerprint(s) == marks[a + i]]
            yield pd.DataFrame({"set": frame["set"].iloc[a:b].to_numpy()[own],
                                "shingles": [sets[i].tobytes() for i in own]})


# -- blocks ---------------------------------------------------------------------------------------

def blocks_of(postings: DataFrame, sizes: DataFrame, hops: int = 2) -> DataFrame:
    """(`set`, `n`, `block`): blocks of the most frequent band that a set reaches in so many hops over
    shared bands. So the sets of a dense group lie together even if no band holds them all."""
    labels = postings.groupBy("set").agg(F.max(F.struct("many", "band")).alias("most"))
    for _ in range(hops):
        held = postings.select("band", "set").join(labels, "set")
        of_band = held.groupBy("band").agg(F.max("most").alias("most"))
        labels = durable(postings.select("band", "set").join(of_band, "band").groupBy("set").agg(
            F.max("most").alias("most")))
    labels = durable(labels.select("set", F.col("most.band").alias("label")).join(sizes, "set"))
    parts = labels.groupBy("label").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("bigint").alias("parts"))
    part = F.pmod(F.xxhash64("set", "label"), F.col("parts"))
    return labels.join(parts, "label").select("set", "n", F.xxhash64("label", part).alias("block"))


def block_pairs(postings: DataFrame, blocks: DataFrame, component: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs (`one`, `two`) of blocks that share a band which joins different components, and
    (`block`, `set`, `n`, `component`) of the sets in such bands."""
    placed = blocks.join(component.select(F.col("id").alias("set"), "component"), "set")
    named = durable(postings.select("band", "set").join(placed, "set"))
    still = named.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    opened = durable(named.join(still.select("band"), "band", "left_semi"))
    held = opened.groupBy("band", "block").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("n").alias("least"), F.max("n").alias("most"))
    other = held.select("band", *[F.col(c).alias(f"o_{c}") for c in held.columns if c != "band"])
    met = held.join(other, "band").where(
        "block < o_block AND NOT (lo = hi AND o_lo = o_hi AND lo = o_lo)").where(
        (100 * F.col("most") >= SIMILAR * F.col("o_least")) & (100 * F.col("o_most") >= SIMILAR * F.col("least")))
    pairs = met.select(F.col("block").alias("one"), F.col("o_block").alias("two")).distinct()
    return pairs, opened.select("block", "set", "n", "component").distinct()


def similar(both, x, y):
    return 100 * both >= SIMILAR * (x + y - both)


def _links(group: list, sides: np.ndarray, part: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect all similar sets of a group; `part`: what is connected already.

    With two sides only sets of different sides are compared, else all.
    """
    sets = [np.frombuffer(r.shingles, "<u8") for r in group]
    sizes = np.array([len(s) for s in sets])
    _, number = np.unique(np.concatenate(sets), return_inverse=True)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    inside = np.zeros(int(number.max()) + 1, dtype=np.int32)
    two = bool(sides.any())
    links = []
    for i in np.flatnonzero(sides == 0):
        later = int(np.searchsorted(sides, 1)) if two else i + 1
        if later >= len(sets):
            break
        able = (part[later:] != part[i]) & similar(np.minimum(sizes[i], sizes[later:]), sizes[i], sizes[later:])
        if not able.any():
            continue
        own = number[begins[i]:begins[i + 1]]
        inside[own] = 1
        both = np.add.reduceat(inside[number[begins[later]:]], begins[later:-1] - begins[later])
        inside[own] = 0
        for j in np.flatnonzero(able & similar(both, sizes[i], sizes[later:])) + later:
            links.append((group[i].set, group[j].set))
            part[part == part[j]] = part[i]
    return links


def _in_block(group: list) -> list[tuple[int, int]]:
    return _links(group, np.zeros(len(group), dtype=int), np.arange(len(group)))


def _across(group: list) -> list[tuple[int, int]]:
    return _links(group, np.array([r.side for r in group]), np.array([r.component for r in group]))


def _grouped(batches, keys, join):
    """`join` the rows of each group; rows arrive ordered by group, which batches may cut."""
    group, key = [], None
    for frame in batches:
        links = []
        for r in frame.itertuples(index=False):
            own = tuple(getattr(r, k) for k in keys)
            if own != key:
                if len(group) > 1:
                    links += join(group)
                group, key = [], own
            group.append(r)
        yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")
    if len(group) > 1:
        yield pd.DataFrame(join(group), columns=["a", "b"], dtype="int64")


def links_in(blocks: DataFrame, shingles: DataFrame) -> DataFrame:
    """Links that connect the similar sets of each block."""
    rows = blocks.select("block", "set").join(shingles, "set")
    return rows.repartition("block").sortWithinPartitions("block", "set").mapInPandas(
        lambda batches: _grouped(batches, ["block"], _in_block), "a bigint, b bigint")


def links_across(pairs: DataFrame, members: DataFrame, shingles: DataFrame) -> DataFrame:
    """Links that connect the similar sets of different components in each pair of blocks."""
    sides = pairs.select("one", "two", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("one").alias("block")),
        F.struct(F.lit(1).alias("side"), F.col("two").alias("block")))).alias("s")).select("one", "two", "s.side", "s.block")
    rows = sides.join(members.select("block", "set", "component"), "block").drop("block").join(shingles, "set")
    return rows.repartition("one", "two").sortWithinPartitions("one", "two", "side", "set").mapInPandas(
        lambda batches: _grouped(batches, ["one", "two"], _across), "a bigint, b bigint")


# -- the whole operator ---------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = WIDTH) -> DataFrame:
    """One row per input row: the id, `n_shingles`, `component_id` and `kept` (it heads its component).

    Texts of fewer than `width` words are one shingle. Null and blank texts have none, are
    linked with nothing and kept. Rows that repeat an id are documents of their own under one
    id. A null id counts for no component's smallest id: such a row is kept only where no
    row with an id is linked with it, and then its `component_id` is null.
    """
    texts = picked(docs, id=id_col, text=text_col).withColumn("digest", F.xxhash64("text"))
    kind = texts.schema["id"].dataType.simpleString()
    rows = durable(texts.mapInPandas(lambda b: _measured(b, width),
                                     f"id {kind}, digest bigint, n bigint, a bigint, b bigint, bands binary"))
    sets = durable(rows.where("n > 0").groupBy("a", "b").agg(
        F.min("id").alias("least"), F.max("n").alias("n"), F.max("bands").alias("bands"),
        F.coalesce(F.min_by("digest", "id"), F.min("digest")).alias("digest")).withColumn(
        "set", F.monotonically_increasing_id()))

    posted = durable(sets.select("set", "bands").mapInPandas(_posted, "band bigint, set bigint"))
    many = posted.groupBy("band").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    postings = durable(posted.join(many, "band"))
    # the text of the smallest id of each set that shares a band
    wanted = postings.select("set").distinct().join(sets.select("set", "least", "digest", "a", "b"), "set")
    named = texts.join(wanted.withColumnRenamed("digest", "_digest"),
                       (F.col("digest") == F.col("_digest")) & F.col("id").eqNullSafe(F.col("least")))
    shingles = durable(named.mapInPandas(lambda b: _shingled(b, width), "set bigint, shingles binary").groupBy(
        "set").agg(F.first("shingles").alias("shingles")))

    nodes = wanted.select(F.col("set").alias("id"))
    blocks = durable(blocks_of(postings, sets.select("set", "n")))
    links = durable(links_in(blocks, shingles))
    part = durable(connected_components(nodes, links))
    pairs, members = block_pairs(postings, blocks, part)
    more = durable(links_across(pairs, members, shingles))
    if not more.isEmpty():
        part = durable(connected_components(nodes, links.unionByName(more)))

    members = part.join(sets.select(F.col("set").alias("id"), "a", "b", "least"), "id")
    heads = members.groupBy("component").agg(F.min("least").alias("head"))
    found = members.join(heads, "component").select("a", "b", "head")
    all_sets = sets.select("a", "b", "least").join(found, ["a", "b"], "left").select(
        "a", "b", F.coalesce("head", "least").alias("head"))
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("head"))
    return rows.join(all_sets, ["a", "b"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"))
