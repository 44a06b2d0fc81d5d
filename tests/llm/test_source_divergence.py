import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.llm import source_divergence as sd

SCHEMA = "doc_id long, lang string, source string, text string"


def brute(rows):
    docs = [(l or "", s or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub(
        "[A-Z]", lambda m: m[0].lower(), t or ""))) for _, l, s, t in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = sorted(t for t in df if df[t] >= 3)
        counts = defaultdict(Counter)
        for l, s, terms in docs:
            if l == lang:
                counts[s].update(t for t in terms if t in set(kept))
        total = sum(counts.values(), Counter())

        def share(c):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(total)
        for s in counts:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in counts if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, 200)):
                out += [(lang, s, part, i.decode(), -v, r) for r, (v, i) in enumerate(sorted(items)[:most], 1)]
    return sorted(out)


def audited(spark, rows):
    return sorted(tuple(r) for r in sd.divergence_audit(spark.createDataFrame(rows, SCHEMA)).collect())


def made(n=300, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in rng.zipf(1.4, rng.integers(0, 60)) % 600]
        rows.append((i, ["en", "de", None][i % 3], None if i % 10 == 4 else f"s{int(rng.integers(0, 5))}", " ".join(words)))
    return rows


@pytest.mark.parametrize("cells", [sd.BLOCK_CELLS, 60])
def test_equals_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(sd, "BLOCK_CELLS", cells)  # small blocks: sums over many of them
    rows = made()
    assert audited(spark, rows) == brute(rows)


def test_edge_cases(spark):
    rows = [(1, "xx", "a", None), (2, "xx", "b", ""), (3, "xx", None, "1 2 3"), (4, None, None, None),
            (5, "yy", "a", "Foo foo2foo Ärger ärger _x" + " " + "y"), (6, "yy", "a", "foo FOO Ärger"),
            (7, "yy", "b", "foo bar Ärger"), (7, "yy", "b", "foo bar Ärger"), (8, "yy", "c", "long " * 50_000)]
    assert audited(spark, rows) == brute(rows)
    assert audited(spark, []) == []


def test_clashing_columns(spark):
    rows = made(60)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("g", "term", "count", "total", "value", "rank", "item", "block", "p", "q"):
        df = df.withColumn(name, F.lit("x"))
    assert sorted(tuple(r) for r in sd.divergence_audit(df).collect()) == brute(rows)


def test_runs_equal_single_terms():
    rng = np.random.default_rng(5)
    x, y = np.sort(rng.integers(0, 4, 50)), rng.integers(0, 3, 50)
    times = rng.integers(1, 5, 50)
    ends = np.concatenate([[0], np.cumsum(times)])
    a, b = sd.RunColumn(x, 90, 70), sd.RunColumn(y, 60, 70)
    p, q = sd.shares(x, 90, 70), sd.shares(y, 60, 70)
    assert sd.divergences(a, b, ends) == (int(((p - q) ** 2 // q * times).sum()), int(((p - q) ** 2 // p * times).sum()))
    huge = np.array([10**13, 5])
    assert sd.shares(huge, 10**14, 10).tolist() == [1 + 10**9 * (int(c) + 1) // (10**14 + 10) for c in huge]
