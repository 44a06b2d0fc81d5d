"""Exact duplicates through an extendible-hash index on shared files (DataFrame functions only).

1. Every text is posted under a 64-bit hash key. Equal texts are merged before
   and after the shuffle by a hash aggregate on (key, text), which compares bytes:
   a group of copies sends one row per task however large it is.
2. The directory starts as one bucket and doubles: the bucket of a key is its
   first `d` bits, with the smallest depth `d` at which the bucket holds at most
   `page_rows` texts. Only counts of key prefixes are looked at.
3. The index is a Parquet table in the checkpoint folder, dealt to owner tasks by
   bucket, each a range of keys. Different texts under one key form a chain.
4. Each row finds its class by key. Rows whose key has a chain of several texts
   compare bytes with the texts of the chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.functions.columns import q
from seriesloom.session import durable

from .common import picked, size_of


def _entries(docs: DataFrame, id_col: str, text_col: str, key_bits: int) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    hashed = F.xxhash64(text)
    key = hashed if key_bits == 64 else F.shiftrightunsigned(hashed, 64 - key_bits)
    return picked(docs, id=id_col, text=text_col).select("id", key.alias("key"), text.alias("text"))


def _cell(depth: int, key_bits: int) -> Column:
    """The first `depth` bits of the key."""
    if depth == 0:
        return F.lit(0).cast("bigint")
    return F.shiftrightunsigned(F.col("key"), key_bits - depth)


def directory(keys: DataFrame, page_rows: int = 50_000, key_bits: int = 64) -> tuple[DataFrame, int]:
    """(`cell`, `depth`, `bucket`) and the number of key bits that name a cell.

    The counts of the finest cells are summed level by level; a cell belongs to
    the first level whose bucket is not overfull. Keys that even the finest cell
    cannot part stay together: that bucket is larger and nothing is lost.
    """
    finest = min(key_bits, 40, max(0, (max(size_of(keys), 1) // page_rows).bit_length()) + 3)
    counts = keys.groupBy(_cell(finest, key_bits).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    levels = counts.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(finest))).alias("depth"))
    prefix = F.expr(f"shiftright(cell, {finest} - depth)")
    full = levels.groupBy("depth", prefix.alias("prefix")).agg(F.sum("n").alias("rows"))
    fits = levels.select("cell", "depth", prefix.alias("prefix")).join(full, ["depth", "prefix"]).where(
        (F.col("rows") <= page_rows) | (F.col("depth") == finest))
    local = fits.groupBy("cell").agg(F.min("depth").alias("depth"))
    bucket = F.concat_ws(":", F.col("depth").cast("string"),
                         F.expr(f"shiftright(cell, {finest} - depth)").cast("string"))
    return local.select("cell", "depth", bucket.alias("bucket")), finest


def hash_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               page_rows: int = 50_000, key_bits: int = 64) -> DataFrame:
    """The index table: `bucket`, `key`, `chain`, `chain_length`, `keep_id`, `group_size`, `sha`."""
    posted = durable(
        _entries(docs, id_col, text_col, key_bits).groupBy("key", "text")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("key", "keep_id", "group_size",
                F.sha2(F.col("text").cast("binary"), 256).alias("sha")))
    cells, depth = directory(posted, page_rows, key_bits)
    owned = posted.withColumn("cell", _cell(depth, key_bits)).join(cells, "cell").repartition("bucket")
    chain = W.partitionBy("bucket", "key")
    return durable(owned.select(
        "bucket", "key", F.row_number().over(chain.orderBy("sha")).alias("chain"),
        F.count(F.lit(1)).over(chain).alias("chain_length"), "keep_id", "group_size", "sha"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                page_rows: int = 50_000, key_bits: int = 64) -> DataFrame:
    """One row per input row: the id, `keep_id`, `group_size`, `kept`, `text_sha256`.

    Of equal texts the row with the largest id stays. A null text counts as empty.
    Rows that repeat an id and its text each count in `group_size`, and one of them
    stays. A null id is smaller than any other and stays only where all are null.
    An empty table gives an empty result; other columns are not looked at.
    `key_bits` below 64 makes collisions common and is meant for tests.
    """
    index = hash_index(docs, id_col, text_col, page_rows, key_bits)
    entries = _entries(docs, id_col, text_col, key_bits)
    classes = index.where("chain_length = 1").select("key", "keep_id", "group_size", "sha")
    found = entries.groupBy("id", "key").agg(F.count(F.lit(1)).alias("copies")).join(classes, "key")
    chained = index.where("chain_length > 1").select("key").distinct()
    if not chained.isEmpty():
        found = found.unionByName(_in_chains(entries, chained))
    return _rows(found, id_col)


def _in_chains(entries: DataFrame, chained: DataFrame) -> DataFrame:
    """Rows of keys with several texts: bytes are compared with those of the chain."""
    several = entries.join(chained, "key", "left_semi")
    texts = several.groupBy("key", "text").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    own = several.groupBy("id", "key", "text").agg(F.count(F.lit(1)).alias("copies"))
    return own.join(texts, ["key", "text"]).select(
        "key", "id", "copies", "keep_id", "group_size",
        F.sha2(F.col("text").cast("binary"), 256).alias("sha"))


def _rows(found: DataFrame, id_col: str) -> DataFrame:
    """Repeated rows come back as often as they were given; the first of them may stay."""
    repeated = found.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("turn"))
    return repeated.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("turn") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, all columns kept.

    An id that occurs with several texts keeps each text whose class it heads.
    """
    decided = exact_dedup(docs, id_col, text_col)
    keep = durable(decided.where("kept").select(F.col(q(id_col)).alias("_keep"), F.col("text_sha256").alias("_sha")))
    sha = F.sha2(F.coalesce(F.col(q(text_col)), F.lit("")).cast("binary"), 256)
    if size_of(keep) == size_of(keep.select("_keep").distinct()) == _distinct_kept(docs, keep, id_col):
        return docs.join(keep, docs[q(id_col)].eqNullSafe(keep["_keep"]), "left_semi")
    marked = docs.withColumn("_sha_of_text", sha)
    kept = marked.join(keep, marked[q(id_col)].eqNullSafe(keep["_keep"]) & (F.col("_sha_of_text") == F.col("_sha")),
                       "left_semi")
    return kept.dropDuplicates([id_col, "_sha_of_text"]).drop("_sha_of_text")


def _distinct_kept(docs: DataFrame, keep: DataFrame, id_col: str) -> int:
    """How many rows a join by id alone would keep."""
    return size_of(picked(docs, id=id_col).join(keep, F.col("id").eqNullSafe(F.col("_keep")), "left_semi"))
