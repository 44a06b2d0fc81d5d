"""Source divergence audit over run-length columns.

How far does the use of words in one source of a language lie from that of its other
sources, and which words set it apart? Every group (language, source) has a column of
counts over the language's kept terms. The columns are never compared term by term:

1. Terms are counted per group with partial counts in the tasks; a language keeps the
   terms that are in `least_docs` of its documents.
2. The vocabulary is reordered by the terms' counts in all groups, so that terms with equal
   counts lie together. Equal ones are one entry with a length.
3. The ordered vocabulary is cut into blocks. In a block the column of each group is
   run-length encoded; for a pair of groups the borders of both columns' runs are merged, and
   a divergence is computed once per merged run and multiplied by its length.
4. Sums over the blocks give the pairs.

All arithmetic is in whole numbers. With p = 1 + floor(10^9 (count + 1) / (N + V)) of a term
in a group with N occurrences of its language's V kept terms, the divergence of p from q is
floor((p - q)^2 / q). A sum over a vocabulary of up to 2 * 10^9 terms fits a long.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.session import durable

from .common import picked, text_slices

LEAST_DOCS, TOP_TERMS, SCALE = 3, 200, 1_000_000_000
BLOCK_CELLS = 1_000_000  # vocabulary entries x groups of a block
SLICE = 12_000_000  # characters counted together in a task

#: A term is a run of ASCII letters and of anything beyond ASCII; only A-Z are lower-cased.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _term_lists(texts: list[str | None]) -> pa.Array:
    """The terms of each text, and empty strings where a text begins or ends with something else."""
    plain = [(t or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES) for t in texts]
    return pc.ascii_split_whitespace(pa.array(plain, pa.large_string()))


def _counts(langs: list, sources: list, texts: list[str | None]) -> pa.RecordBatch:
    """(lang, source, term, count, docs) of a slice of documents."""
    lists = _term_lists(texts)
    words = lists.flatten().dictionary_encode()
    names, size = words.dictionary, max(1, len(words.dictionary))
    owner = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy())
    term = words.indices.to_numpy().astype(np.int64)
    is_word = pc.not_equal(names, "").to_numpy(zero_copy_only=False)[term]
    group: dict[tuple, int] = {}
    of_text = np.array([group.setdefault(g, len(group)) for g in zip(langs, sources)], dtype=np.int64)
    in_doc, times = np.unique(owner[is_word] * size + term[is_word], return_counts=True)
    in_group = of_text[in_doc // size] * size + in_doc % size
    order = np.argsort(in_group, kind="stable")
    code, first, docs = np.unique(in_group[order], return_index=True, return_counts=True)
    count = np.add.reduceat(times[order], first) if len(first) else first
    keys = list(group)
    return pa.RecordBatch.from_arrays([
        pa.array([k[i] for k in keys], pa.string()).take(pa.array(code // size)) for i in (0, 1)] + [
        names.take(pa.array(code % size)).cast(pa.string()), pa.array(count.astype(np.int64)),
        pa.array(docs.astype(np.int64))], names=["lang", "source", "term", "count", "docs"])


def _counted(batches):
    for batch in batches:
        lang, source, text = (batch.column(c).to_pylist() for c in ("lang", "source", "text"))
        for a, b in text_slices(text, SLICE):
            yield _counts(lang[a:b], source[a:b], text[a:b])


def share(count, total, terms):
    """p of a count, exactly (columns; products beyond 64 bits are decimals)."""
    return F.expr(f"CAST(CAST({SCALE} AS DECIMAL(38,0)) * ({count} + 1) AS DECIMAL(38,0)) "
                  f"DIV CAST({total} + {terms} AS DECIMAL(38,0)) + 1").cast("bigint")


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """p of an array of counts, exactly."""
    if len(counts) and int(counts.max()) >= (1 << 62) // SCALE:
        return np.array([1 + SCALE * (int(c) + 1) // (total + terms) for c in counts], dtype=np.int64)
    return 1 + SCALE * (counts + 1) // (total + terms)


class RunColumn:
    """A column of counts as runs: where each starts, and the p that holds in it."""

    def __init__(self, counts: np.ndarray, total: int, terms: int):
        self.starts = np.concatenate([[0], np.flatnonzero(counts[1:] != counts[:-1]) + 1])
        self.p = shares(counts[self.starts], total, terms)


def divergences(x: RunColumn, y: RunColumn, ends: np.ndarray) -> tuple[int, int]:
    """Summed divergence of x from y and of y from x; `ends[i]` terms lie before entry i."""
    starts = np.union1d(x.starts, y.starts)
    p = x.p[np.searchsorted(x.starts, starts, side="right") - 1]
    q = y.p[np.searchsorted(y.starts, starts, side="right") - 1]
    length = np.diff(ends[np.append(starts, len(ends) - 1)])
    square = (p - q) ** 2
    return int((square // q * length).sum()), int((square // p * length).sum())


def _pairs_of_block(key, entries: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Divergences of all pairs of groups over one block of the vocabulary."""
    groups = groups.sort_values("g")
    columns = np.zeros((len(groups), len(entries)), dtype=np.int64)
    if len(entries):
        # entries come in no order from the shuffle: put equal counts side by side again
        held = entries["gs"].map(len).to_numpy()
        g = np.concatenate(entries["gs"].to_list()).astype(np.int64)
        columns[g, np.repeat(np.arange(len(entries)), held)] = np.concatenate(entries["counts"].to_list())
        order = np.lexsort(columns[::-1])
        columns = columns[:, order]
        ends = np.concatenate([[0], np.cumsum(entries["times"].to_numpy()[order])])
        terms = int(groups["v"].iloc[0])
        runs = [RunColumn(c, int(n), terms) for c, n in zip(columns, groups["n"])]
    rows = []
    for i in range(len(groups) if len(entries) else 0):
        for j in range(i):
            forth, back = divergences(runs[i], runs[j], ends)
            rows += [(key[0], i, j, forth), (key[0], j, i, back)]
    return pd.DataFrame(rows, columns=["lang", "g", "other", "value"])


def vectors(texts: DataFrame, groups: DataFrame, least_docs: int) -> DataFrame:
    """(`lang`, `term`, `total`, `gs`, `counts`) of the kept terms: the groups that have the term, by
    number, and how often. A row is as long as its language has sources with the term."""
    counted = texts.mapInArrow(_counted, "lang string, source string, term string, count bigint, docs bigint")
    numbered = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("count").alias("count"), F.sum("docs").alias("docs")).withColumn(
        "docs", F.sum("docs").over(W.partitionBy("lang", "term"))).where(F.col("docs") >= least_docs).join(
        groups.select("lang", "source", "g"), ["lang", "source"])
    cells = F.sort_array(F.collect_list(F.struct("g", "count")))
    return numbered.groupBy("lang", "term").agg(F.sum("count").alias("total"), cells.alias("cells")).select(
        "lang", "term", "total", F.col("cells.g").alias("gs"), F.col("cells.count").alias("counts"))


def divergence_audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                     least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(`lang`, `source`, `part`, `item`, `value`, `rank`).

    Part `pair` has each other source of the language with the summed divergence of the group
    from it; part `term` has the group's terms that it uses more than its language does, with
    the divergence from the language, the `top_terms` largest. Null texts, languages and
    sources are ''. A group of empty texts is a group; a language without kept terms has
    divergence 0 between its groups; a table without rows has no rows. Repeated rows
    count again, as documents of their own.
    """
    texts = picked(docs, lang=lang_col, source=source_col, text=text_col).select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), "text")
    by_name = W.partitionBy("lang").orderBy("source")
    groups = durable(texts.select("lang", "source").distinct().withColumn("g", F.row_number().over(by_name) - 1))
    kept = durable(vectors(texts, groups, least_docs))

    of_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("n_lang"))
    cells = kept.select("lang", "term", "total", F.explode(F.arrays_zip("gs", "counts")).alias("cell")).select(
        "lang", "term", "total", F.col("cell.gs").alias("g"), F.col("cell.counts").alias("count"))
    of_group = cells.groupBy("lang", "g").agg(F.sum("count").alias("n"))
    sized = durable(groups.join(of_lang, "lang", "left").join(of_group, ["lang", "g"], "left").fillna(
        0, ["v", "n_lang", "n"]))

    pairs = _pair_sums(kept, sized)
    other = groups.select("lang", F.col("g").alias("other"), F.col("source").alias("item"))
    pair_part = groups.join(other, "lang").where(F.col("g") != F.col("other")).join(
        pairs, ["lang", "g", "other"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("bigint").alias("value"))

    used = cells.join(sized, ["lang", "g"]).withColumn("p", share("count", "n", "v")).withColumn(
        "q", share("total", "n_lang", "v")).where("p > q")
    term_part = used.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                            F.expr("((p - q) * (p - q)) DIV q").alias("value"))
    ranked = W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return pair_part.withColumn("rank", F.row_number().over(ranked)).unionByName(
        term_part.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top_terms))


def _pair_sums(kept: DataFrame, sized: DataFrame) -> DataFrame:
    """(`lang`, `g`, `other`, `value`) summed over the blocks of the reordered vocabulary."""
    entries = durable(kept.groupBy("lang", "gs", "counts").agg(F.count(F.lit(1)).alias("times")))
    width = sized.groupBy("lang").agg(F.count(F.lit(1)).alias("width"))
    size = entries.groupBy("lang").count().join(width, "lang").agg(F.sum(F.col("count") * F.col("width"))).first()[0]
    parts = max(1, -(-(size or 0) // BLOCK_CELLS))
    blocks = durable(entries.repartitionByRange(parts, "lang", "gs", "counts").withColumn(
        "block", F.spark_partition_id()))
    names = blocks.select(F.col("lang").alias("_lang"), F.col("block").alias("part")).distinct()
    named = names.join(sized, F.col("_lang") == F.col("lang")).select("lang", "part", "g", "n", "v")
    sums = blocks.groupBy("lang", "block").cogroup(named.groupBy("lang", "part")).applyInPandas(
        _pairs_of_block, "lang string, g int, other int, value bigint")
    return sums.groupBy("lang", "g", "other").agg(F.sum("value").alias("value"))
