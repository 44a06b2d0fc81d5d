"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


from .common import table  # noqa: E402
from . import chat_format, circulant_minhash, cover_tree, exact_dedup, html_text, mixing, ngram_join, packing, permutation_index, quality, source_divergence, token_files, toxicity  # noqa: E402
from .tokens import read_vocabulary  # noqa: E402


def vocabulary(name: str) -> str:
    import public_tokenizers  # the installed files; any other path will do

    return read_vocabulary(public_tokenizers.path(name))


@register("op1_source_mix")
def op1_source_mix(spark, sf_dir):
    return mixing.taken(table(spark, sf_dir, "documents"))


@register("op6_exact_dedup", """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
     g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT t.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size, t.doc_id = g.keep_id AS kept,
       sha256(t.text) AS text_sha256
FROM t JOIN g ON t.text = g.text""")
def op6_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@register("op3_sequence_packing")
def op3_sequence_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@register("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@register("op9_quality")
def op9_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@register("op2_ngram_join")
def op2_ngram_join(spark, sf_dir):
    return ngram_join.similar_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


@register("op10_html_extraction")
def op10_html_extraction(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


#: Texts that look like the control strings of a chat template.
CONTROL_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


@register("op4_chat_formatting")
def op4_chat_formatting(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = given.unionByName(spark.createDataFrame(CONTROL_CONVERSATION, given.schema))
    return chat_format.digests(chat_format.format_conversations(rows))


@register("op8_token_files")
def op8_token_files(spark, sf_dir):
    return token_files.round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@register("op5_permutation_index")
def op5_permutation_index(spark, sf_dir):
    return permutation_index.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0)


@register("op13_source_divergence", r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
           FROM documents),
     w AS (SELECT id, lang, source, unnest(terms) AS term FROM d),
     c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
     k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 3),
     g AS (SELECT DISTINCT lang, source FROM d),
     v AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS n FROM k GROUP BY lang),
     cells AS (SELECT g.lang, g.source, k.term, k.total, coalesce(c.n, 0)::HUGEINT AS n
               FROM g JOIN k ON g.lang = k.lang
               LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
     s AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM cells GROUP BY ALL),
     p AS (SELECT cells.lang, cells.source, term, cells.n,
                  1 + (1000000000::HUGEINT * (cells.n + 1)) // (s.total + v.v) AS p,
                  1 + (1000000000::HUGEINT * (cells.total + 1)) // (v.n + v.v) AS q
           FROM cells JOIN s ON s.lang = cells.lang AND s.source = cells.source JOIN v ON v.lang = cells.lang),
     pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
               FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
     found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value
               FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
               LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
               UNION ALL
               SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE n > 0 AND p > q),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
                FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200""")
def op13_source_divergence(spark, sf_dir):
    return source_divergence.divergence_audit(table(spark, sf_dir, "documents"))


@register("op12_circulant_minhash", r"""
WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS shingles
      FROM d),
one AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
rare AS (SELECT shingle FROM one GROUP BY shingle HAVING count(*) > 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM one a JOIN rare USING (shingle) JOIN one b USING (shingle)
      WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
      HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS id, doc_id AS other FROM s
          UNION SELECT reach.id, p.b FROM reach JOIN p ON p.a = reach.other),
c AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT s.doc_id, len(shingles)::BIGINT AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM s JOIN c ON c.id = s.doc_id""")
def op12_circulant_minhash(spark, sf_dir):
    return circulant_minhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op11_hard_negatives", """
WITH r AS (SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END)::BIGINT AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
                  list_inner_product(a.v, b.v)::BIGINT AS score
           FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
     p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id, row_number() OVER w::INTEGER AS rank, s.id AS negative_id,
       p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
              AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 10""")
def op11_hard_negatives(spark, sf_dir):
    return cover_tree.hard_negatives(table(spark, sf_dir, "embeddings"),
                                     lambda i: i % 100 == 0, lambda i: i % 7 == 0)
