"""N-gram Jaccard join: globally ordered shingle sets in tries, joined with length bounds.

The sets of distinct `width`-word shingles are joined at Jaccard >= 3/4 without all pairs:

1. Equal sets are one set, named by a 128-bit fingerprint, so copies cost nothing below.
2. Document frequencies over the distinct sets are counted exactly. Shingles travel as
   packed arrays by hash range; shingles in a 128th of all documents or more are found
   beforehand (there are few of them) and need no range, so no range grows with one.
3. The global order is rarest first. A shingle of one set alone can link nothing, so
   it is only counted. A set whose prefix (n - ceil(3n/4) + 1 rarest shingles) holds only
   such shingles is out.
4. Sets that share a prefix shingle are candidates. To save the pairs of a large group,
   sets first meet in groups: each picks a few of its prefix shingles by a hash that
   all sets share, so similar sets mostly pick alike, and the sets of one shingle, in chunks
   of bounded size, are joined with one another unless they are connected already.
   Then components are taken; shingles that still join different components offer
   groups again, and at last all the pairs that are left.
5. A group's ordered sets are laid out as a trie (sorted, with the length of the path each
   shares with the one before). Walking it, overlap with a set is counted once for a
   shared path, and a subtree is left as soon as its remaining length cannot reach the
   overlap needed.
6. Components of the verified links.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.columns import q
from seriesloom.operators.graph import connected_components
from seriesloom.session import durable

from .common import picked, size_of, text_slices
from .words import mix, word_hashes

WIDTH = 5
HOT = 256  # a shingle in more than one of so many documents is hot
RANGE_TOKENS = 2_000_000
CHUNK_SETS = 64
_STEPS = np.random.Generator(np.random.PCG64(11)).integers(1, 2**62, size=64, dtype=np.uint64) | np.uint64(1)


# -- shingle sets ---------------------------------------------------------------------------------

def shingle_sets(texts: list[str], width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; shorter texts are one shingle."""
    owner, words = word_hashes(texts)
    n = np.bincount(owner, minlength=len(texts))
    ends = np.concatenate([[0], np.cumsum(n)])
    rolled = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
    for k in range(width):
        rolled += mix(words[k:k + len(rolled)] * _STEPS[k])
    rolled = mix(rolled)
    out = []
    for i in range(len(texts)):
        if n[i] >= width:
            out.append(np.unique(rolled[ends[i]:ends[i + 1] - width + 1]))
        elif n[i]:
            short = mix(words[ends[i]:ends[i + 1]] * _STEPS[:n[i]]).sum(keepdims=True) + np.uint64(n[i])
            out.append(mix(short * _STEPS[-1]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(tokens: np.ndarray) -> tuple[int, int]:
    a = mix(tokens * _STEPS[40]).sum(dtype=np.uint64)
    b = mix(tokens * _STEPS[41] + np.uint64(len(tokens))).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def overlap_needed(x, y):
    """Smallest intersection of sets of sizes x and y with 100 * both >= 75 * either."""
    return (3 * (x + y) + 6) // 7


def _measured(batches, width):
    for frame in batches:
        texts = frame["text"].tolist()
        for a, b in text_slices(texts):
            sets = shingle_sets(texts[a:b], width)
            marks = [fingerprint(s) if len(s) else (None, None) for s in sets]
            yield pd.DataFrame({"id": frame["id"].iloc[a:b].to_numpy(), "digest": frame["digest"].iloc[a:b].to_numpy(),
                                "n": [len(s) for s in sets],
                                "a": pd.array([m[0] for m in marks], dtype="Int64"),
                                "b": pd.array([m[1] for m in marks], dtype="Int64")})


def _often(batches, width):
    """(shingle, count) of those in more than one of 2 * HOT documents of a slice."""
    for frame in batches:
        texts = frame["text"].tolist()
        for a, b in text_slices(texts):
            sets = shingle_sets(texts[a:b], width)
            found, count = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_counts=True)
            often = count > max(1, (b - a) // (2 * HOT))
            yield pd.DataFrame({"token": found[often].view(np.int64), "count": count[often]})


# -- counting in ranges ---------------------------------------------------------------------------

def _packed(part, sets, marks, frequencies=None) -> dict:
    """Sets (arrays) of one part as one row; a set is named by half its mark, in lists of 255 shingles."""
    cut = [(m, s[k:k + 255]) for m, s in zip(marks, sets) for k in range(0, len(s), 255)]
    return {"part": part, "marks": np.array([m for m, _ in cut], dtype="<i8").tobytes(),
            "counts": np.array([len(s) for _, s in cut], dtype="u1").tobytes(),
            "tokens": np.concatenate(sets).astype("<u8").tobytes(),
            "df": (np.concatenate(frequencies) if frequencies else np.zeros(0)).astype("<i8").tobytes(), "sizes": b""}


PACKED = "part int, marks binary, counts binary, tokens binary, df binary, sizes binary"


def _unpacked(frame: pd.DataFrame):
    """(mark, set number of each token, token, df) of all rows, equal sets numbered alike."""
    marks = np.frombuffer(b"".join(frame["marks"]), "<i8")
    counts = np.frombuffer(b"".join(frame["counts"]), "u1")
    names, number = np.unique(marks, return_inverse=True)
    return (names, np.repeat(number, counts), np.frombuffer(b"".join(frame["tokens"]), "<u8"),
            np.frombuffer(b"".join(frame["df"]), "<i8"))


def _sized(part: int, known: list[tuple]) -> dict:
    """(mark, size) of sets, once for all their shingles."""
    sizes = np.array([(*mark, n) for mark, n in known], dtype="<i8").tobytes()
    return {"part": part, "marks": b"", "counts": b"", "tokens": b"", "df": b"", "sizes": sizes}


def _dealt(batches, width, ranges, buckets, hot):
    """Shingles by hash range (parts from 0); hot ones straight to their set's bucket (parts below 0)."""
    hot_tokens, hot_df = hot.value
    for frame in batches:
        texts = frame["text"].tolist()
        for a, b in text_slices(texts):
            parts: dict[int, list] = {}
            known: dict[tuple, int] = {}
            for tokens in shingle_sets(texts[a:b], width):
                if not len(tokens):
                    continue
                mark = fingerprint(tokens)
                if mark in known:
                    continue
                known[mark] = len(tokens)
                at = np.searchsorted(hot_tokens, tokens)
                is_hot = hot_tokens[np.minimum(at, len(hot_tokens) - 1)] == tokens if len(hot_tokens) else np.zeros(
                    len(tokens), dtype=bool)
                if is_hot.any():
                    parts.setdefault(-1 - bucket_of(mark, buckets), []).append(
                        (tokens[is_hot], mark[0], hot_df[at[is_hot]]))
                rest = tokens[~is_hot]
                where = ((rest >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
                cuts = np.searchsorted(where, np.arange(ranges + 1))  # tokens ascend, so ranges do
                for r in np.flatnonzero(np.diff(cuts)):
                    parts.setdefault(int(r), []).append((rest[cuts[r]:cuts[r + 1]], mark[0], None))
            if known:
                by_bucket: dict[int, list] = {}
                for mark, n in known.items():
                    by_bucket.setdefault(-1 - bucket_of(mark, buckets), []).append((mark, n))
                yield pd.DataFrame([
                    _packed(p, [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows] if p < 0 else None)
                    for p, rows in parts.items()] + [_sized(p, sets) for p, sets in by_bucket.items()])


def bucket_of(mark, buckets: int) -> int:
    return (mark[0] & 0x7FFFFFFF) % buckets


def _counted(frame: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """One range: the shingles of several sets with their frequency, by bucket of the set.

    Rows that have their bucket already go through as they are.
    """
    if frame["part"].iloc[0] < 0:
        return frame
    names, number, token, _ = _unpacked(frame)
    order = np.lexsort((number, token))
    token, number = token[order], number[order]
    once = np.ones(len(token), dtype=bool)
    once[1:] = (token[1:] != token[:-1]) | (number[1:] != number[:-1])
    token, number = token[once], number[once]
    starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, int)
    df = np.repeat(np.diff(np.append(starts, len(token))), np.diff(np.append(starts, len(token))))
    shared = df > 1
    token, number, df = token[shared], number[shared], df[shared]
    order = np.argsort(number, kind="stable")
    token, number, df = token[order], number[order], df[order]
    used, first, count = np.unique(number, return_index=True, return_counts=True)
    where = (names[used] & 0x7FFFFFFF) % buckets
    rows = []
    for p in np.unique(where):
        own = np.flatnonzero(where == p)
        take = [slice(first[i], first[i] + count[i]) for i in own]
        rows.append(_packed(-1 - int(p), [token[t] for t in take], names[used[own]].tolist(), [df[t] for t in take]))
    return pd.DataFrame(rows, columns=["part", "marks", "counts", "tokens", "df", "sizes"])


def _ordered(frame: pd.DataFrame) -> pd.DataFrame:
    """One bucket: its sets in global order, those with a shared shingle in their prefix."""
    names, number, token, df = _unpacked(frame)
    order = np.lexsort((token, df, number))
    token, df, number = token[order], df[order], number[order]
    once = np.ones(len(token), dtype=bool)  # copies of a set have each sent its hot shingles
    once[1:] = (token[1:] != token[:-1]) | (number[1:] != number[:-1])
    token, df, number = token[once], df[once], number[once]
    ends = np.searchsorted(number, np.arange(len(names) + 1))
    known = np.unique(np.frombuffer(b"".join(frame["sizes"]), "<i8").reshape(-1, 3), axis=0)
    place = np.searchsorted(names, known[:, 0])
    rows = []
    for (a, b, n), i in zip(known.tolist(), place.tolist()):
        if i == len(names) or names[i] != a:
            continue  # no shared shingle
        held = int(ends[i + 1] - ends[i])
        alone = n - held
        prefix = n - (3 * n + 3) // 4 + 1 - alone
        if prefix > 0:
            own = slice(ends[i], ends[i + 1])
            rows.append((a, b, n, min(prefix, held), token[own].tobytes(),
                         np.minimum(df[own], 2**32 - 1).astype("<u4").tobytes()))
    return pd.DataFrame(rows, columns=["a", "b", "n", "prefix", "tokens", "df"])


def shared_sets(texts: DataFrame, sets: DataFrame, width: int) -> DataFrame:
    """(`set`, `n`, `prefix`, `tokens`, `df`) of the sets that can link at all.

    `tokens` holds the shingles shared with another set, rarest first, of which the first
    `prefix` belong to the set's prefix; the others of its `n` shingles are its own.
    """
    spark = texts.sparkSession
    totals = sets.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    ranges = max(1, -(-totals[1] // RANGE_TOKENS))
    least = max(16, totals[0] // HOT)
    often = texts.mapInPandas(lambda b: _often(b, width), "token bigint, count bigint").groupBy("token").agg(
        F.sum("count").alias("count")).where(F.col("count") > least)
    # at most HOT times the mean set: every hot shingle is in a HOT-th of the documents
    found = sorted((r["token"] & (2**64 - 1), r["count"]) for r in often.collect())
    hot = spark.sparkContext.broadcast((np.array([t for t, _ in found], dtype=np.uint64),
                                        np.array([c for _, c in found], dtype=np.int64)))
    dealt = texts.mapInPandas(lambda b: _dealt(b, width, ranges, ranges, hot), PACKED)
    counted = dealt.groupBy("part").applyInPandas(lambda frame: _counted(frame, ranges), PACKED)
    ordered = counted.groupBy("part").applyInPandas(
        _ordered, "a bigint, b bigint, n bigint, prefix int, tokens binary, df binary")
    return durable(ordered.join(sets.select("a", "b", "set"), ["a", "b"]).drop("a", "b"))


# -- candidates -----------------------------------------------------------------------------------

def _prefixes(batches):
    for frame in batches:
        token = [np.frombuffer(t, "<u8", count=p) for t, p in zip(frame["tokens"], frame["prefix"])]
        times = frame["prefix"].to_numpy()
        held = np.array([len(t) // 8 for t in frame["tokens"]])
        place = np.concatenate([np.arange(p) for p in times]) if len(times) else np.zeros(0, int)
        yield pd.DataFrame({"token": np.concatenate([*token, np.zeros(0, np.uint64)]).view(np.int64),
                            "set": np.repeat(frame["set"].to_numpy(), times),
                            "n": np.repeat(frame["n"].to_numpy(), times),
                            "place": place + np.repeat(frame["n"].to_numpy() - held, times)})


def _fits(x: str, y: str):
    """Length and place bounds of a pair at a shared shingle.

    Similar sets meet them at their first shared shingle at the latest: nothing before it
    counts, so what is left of either set from there on must hold the overlap needed.
    """
    small, large = F.least(F.col(f"{x}n"), F.col(f"{y}n")), F.greatest(F.col(f"{x}n"), F.col(f"{y}n"))
    need = F.floor((3 * (F.col(f"{x}n") + F.col(f"{y}n")) + 6) / 7)
    rest = F.least(F.col(f"{x}n") - F.col(f"{x}place"), F.col(f"{y}n") - F.col(f"{y}place"))
    return (4 * small >= 3 * large) & (rest >= need)


def meetings(postings: DataFrame, rounds: range) -> DataFrame:
    """(`token`, `chunk`, `set`): for each round the prefix shingle of smallest hash that a set has,
    with the others that pick it, in chunks of about CHUNK_SETS."""
    picks = [F.min_by("token", F.xxhash64("token", F.lit(r))).alias(f"t{r}") for r in rounds]
    chosen = postings.groupBy("set").agg(*picks).select(
        "set", F.explode(F.array_distinct(F.array(*[f"t{r}" for r in rounds]))).alias("token"))
    chosen = durable(chosen)
    many = chosen.groupBy("token").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    return chosen.join(many, "token").select("token", "set", F.pmod(
        F.xxhash64("set", "token"), F.ceil(F.col("many") / CHUNK_SETS).cast("bigint")).cast("int").alias("chunk"))


def open_postings(postings: DataFrame, component: DataFrame) -> DataFrame:
    """The postings, with `component`, of shingles that join different components."""
    named = durable(postings.join(component.select(F.col("id").alias("set"), "component"), "set"))
    still = named.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    return durable(named.join(still.select("token"), "token", "left_semi"))


def left_pairs(still: DataFrame) -> DataFrame:
    """All pairs of different components under a shingle of `open_postings`.

    The smaller set leads: its place must leave it the overlap needed with a set of its own
    size at least, which bounds the other's size too. So it looks only at the size classes
    up to that bound, and most of a frequent shingle's postings lead nowhere.
    """
    def size_class(n):
        return F.floor(F.log(n.cast("double")) * 10).cast("int")

    upto = (4 * F.col("n") - 7 * F.col("place")) / 3
    lead = still.where(7 * F.col("place") <= F.col("n")).withColumn(
        "class", F.explode(F.sequence(size_class(F.col("n")), size_class(F.greatest(upto, F.col("n")) + 1))))
    other = still.withColumn("class", size_class(F.col("n"))).select(
        "token", "class", *[F.col(c).alias(f"o{c}") for c in ("set", "n", "place", "component")])
    first = (F.col("n") < F.col("on")) | ((F.col("n") == F.col("on")) & (F.col("set") < F.col("oset")))
    met = lead.join(other, ["token", "class"]).where(
        first & (F.col("component") != F.col("ocomponent")) & _fits("", "o"))
    return met.select(F.col("set").alias("a"), F.col("oset").alias("b")).distinct()


# -- the trie -------------------------------------------------------------------------------------

class Trie:
    """Ordered sets sharing their common paths: sequences in lexicographic order and how much
    of its path each shares with the one before."""

    def __init__(self, sequences: list[np.ndarray]):
        self.order = sorted(range(len(sequences)), key=lambda i: sequences[i].astype(">u4").tobytes())
        self.paths = [sequences[i] for i in self.order]
        self.shared = [0] * len(self.paths)
        for i in range(1, len(self.paths)):
            x, y = self.paths[i - 1], self.paths[i]
            m = min(len(x), len(y))
            differ = np.flatnonzero(x[:m] != y[:m])
            self.shared[i] = int(differ[0]) if len(differ) else m

    def overlaps(self, probe: np.ndarray, needed: list[int], alphabet: int, skip=()) -> dict[int, int]:
        """Overlap with `probe` of every set, but those in `skip`, that reaches its own `needed`."""
        inside = np.zeros(alphabet + 1, dtype=bool)
        inside[probe] = True
        after = len(probe) - np.searchsorted(probe, np.arange(alphabet), side="right")  # of the probe, past a number
        met = np.zeros(1, dtype=np.int64)  # met[d]: overlap of the first d steps of the path
        found, least = {}, len(probe) + alphabet
        for i, (path, shared) in enumerate(zip(self.paths, self.shared)):
            least = min(least, shared)  # what is shared with the last set looked at
            if self.order[i] in skip:
                continue
            shared, least = least, len(probe) + alphabet
            want = needed[self.order[i]]
            depth = min(shared, len(met) - 1)  # a pruned path is known down to its cut only
            met = met[:depth + 1]
            if depth and met[depth] + min(len(path) - depth, int(after[path[depth - 1]])) < want:
                continue
            for start in range(depth, len(path), 256):
                step = path[start:start + 256]
                met = np.append(met, met[-1] + np.cumsum(inside[step]))
                if met[-1] + min(len(path) - start - len(step), int(after[step[-1]])) < want:
                    break
            else:
                if met[len(path)] >= want:
                    found[self.order[i]] = int(met[len(path)])
        return found


def _ranked(rows: list) -> tuple[list[np.ndarray], int]:
    """The sets as ascending numbers in the global order, and how many numbers there are."""
    token = np.concatenate([np.frombuffer(r.tokens, "<u8") for r in rows])
    df = np.concatenate([np.frombuffer(r.df, "<u4") for r in rows])
    order = np.lexsort((token, df))
    ranked = np.empty(len(token), dtype=np.int64)
    ranked[order] = np.cumsum(np.concatenate([[0], (token[order][1:] != token[order][:-1])])) if len(token) else 0
    ends = np.cumsum([len(r.tokens) // 8 for r in rows])
    return [ranked[e - len(r.tokens) // 8:e] for e, r in zip(ends, rows)], int(ranked.max(initial=0)) + 1


def _with_centre(rows: list) -> list[tuple[int, int]]:
    """Links of one centre (the first row) with its partners."""
    sequences, alphabet = _ranked(rows)
    needed = [overlap_needed(rows[0].n, r.n) for r in rows[1:]]
    return [(rows[0].set, rows[1 + i].set) for i in Trie(sequences[1:]).overlaps(sequences[0], needed, alphabet)]


def _with_each_other(rows: list) -> list[tuple[int, int]]:
    """Links that connect all similar sets of a group."""
    sequences, alphabet = _ranked(rows)
    trie = Trie(sequences)
    group = list(range(len(rows)))  # the component of each set
    links = []
    for i, own in enumerate(rows):
        skip = {j for j in range(len(rows)) if j <= i or group[j] == group[i]
                or 4 * min(own.n, rows[j].n) < 3 * max(own.n, rows[j].n)}
        if len(skip) == len(rows):
            continue
        needed = [overlap_needed(own.n, r.n) for r in rows]
        for j in trie.overlaps(sequences[i], needed, alphabet, skip):
            links.append((own.set, rows[j].set))
            if group[j] != group[i]:
                group = [group[i] if g == group[j] else g for g in group]
    return links


def _grouped(batches, join):
    """`join` the rows of every group; rows arrive ordered by group."""
    group, key = [], None
    for frame in batches:
        links = []
        for r in frame.itertuples(index=False):
            if (r.key, r.chunk) != key:
                if len(group) > 1:
                    links += join(group)
                group, key = [], (r.key, r.chunk)
            group.append(r)
        yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")
    if len(group) > 1:
        yield pd.DataFrame(join(group), columns=["a", "b"], dtype="int64")


def links_in(meeting: DataFrame, sets: DataFrame) -> DataFrame:
    """Links that connect the similar sets of each chunk of `meetings`."""
    rows = meeting.join(sets.select("set", "n", "tokens", "df"), "set").withColumnRenamed("token", "key")
    return rows.repartition("key", "chunk").sortWithinPartitions("key", "chunk", "n", "set").mapInPandas(
        lambda batches: _grouped(batches, _with_each_other), "a bigint, b bigint")


def links_of(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (`a`, `b`) that are similar. A centre's partners come in chunks of about CHUNK_SETS."""
    pairs = durable(pairs)
    both = pairs.groupBy("a").count().withColumnRenamed("count", "of_a")
    other = pairs.groupBy("b").count().withColumnRenamed("count", "of_b")
    turned = pairs.join(both, "a").join(other, "b").select(
        F.when(F.col("of_a") >= F.col("of_b"), F.col("a")).otherwise(F.col("b")).alias("key"),
        F.when(F.col("of_a") >= F.col("of_b"), F.col("b")).otherwise(F.col("a")).alias("set"),
        F.greatest("of_a", "of_b").alias("many"))
    chunked = turned.select("key", "set", F.pmod(F.xxhash64("set"), F.ceil(
        F.col("many") / CHUNK_SETS).cast("bigint")).cast("int").alias("chunk"))
    data = sets.select("set", "n", "tokens", "df")
    partners = chunked.join(data, "set").withColumn("role", F.lit(1))
    centres = chunked.select("key", "chunk").distinct().withColumn("set", F.col("key")).join(
        data, "set").withColumn("role", F.lit(0))
    rows = centres.unionByName(partners.select(centres.columns)).repartition("key", "chunk").sortWithinPartitions(
        "key", "chunk", "role", "set")
    return rows.mapInPandas(lambda batches: _grouped(batches, _with_centre), "a bigint, b bigint")


# -- the whole join -------------------------------------------------------------------------------

def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      width: int = WIDTH) -> DataFrame:
    """One row per input row: the id, `n_shingles`, `component_id`, and the text's `digest`.

    Texts of fewer than `width` words are one shingle. Null and blank texts have no shingle
    and are linked with nothing. Rows that repeat an id are documents of their own under one
    id. A null id counts for no component's smallest id; a component of null ids has none.
    """
    texts = picked(docs, id=id_col, text=text_col)
    kind = texts.schema["id"].dataType.simpleString()
    rows = durable(texts.withColumn("digest", F.xxhash64("text")).mapInPandas(
        lambda b: _measured(b, width), f"id {kind}, digest bigint, n bigint, a bigint, b bigint"))
    sets = durable(rows.where("n > 0").groupBy("a", "b").agg(F.min("id").alias("least"), F.max("n").alias("n"))
                   .withColumn("set", F.monotonically_increasing_id()))
    able = shared_sets(texts.select("text"), sets, width)
    postings = durable(able.select("set", "n", "prefix", "tokens").mapInPandas(
        _prefixes, "token bigint, set bigint, n bigint, place bigint"))
    nodes = able.select(F.col("set").alias("id"))
    links = durable(links_in(meetings(postings, range(2)), able))
    part = durable(connected_components(nodes, links))
    still = open_postings(postings, part)
    links = durable(links.unionByName(links_in(meetings(still, range(2, 5)), able)))
    part = durable(connected_components(nodes, links))
    more = durable(links_of(left_pairs(open_postings(postings, part)), able))
    if not more.isEmpty():
        part = durable(connected_components(nodes, links.unionByName(more)))
    named = part.join(sets.select(F.col("set").alias("id"), "a", "b", "least"), "id")
    heads = named.groupBy("component").agg(F.min("least").alias("component_id"))
    found = named.join(heads, "component").select("a", "b", "component_id")
    all_sets = sets.select("a", "b", "least").join(found, ["a", "b"], "left").select(
        "a", "b", F.coalesce("component_id", "least").alias("component_id"))
    return rows.join(all_sets, ["a", "b"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"), "digest")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that head their component, all columns kept. Ids are whole numbers.

    Rows without an id come after all others: a component made of them alone keeps one.
    Equal rows are kept or dropped together; take exact copies out before.
    """
    late = F.lit(2**63 - 1) - F.pmod(F.xxhash64(F.col(q(text_col))), F.lit(1 << 32))
    named = docs.select(F.coalesce(F.col(q(id_col)).cast("bigint"), late).alias("id"), F.col(q(text_col)).alias("text"))
    found = similar_documents(named, "id", "text")
    stays = durable(found.where(F.col("id") == F.col("component_id")).select(
        F.col("id").alias("_stays"), F.col("digest").alias("_digest")))
    same = (F.coalesce(F.col(q(id_col)).cast("bigint"), late) == F.col("_stays")) & (
        F.xxhash64(F.col(q(text_col))) == F.col("_digest"))
    return docs.join(stays, same, "left_semi")
