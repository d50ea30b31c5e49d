"""The queries of this subpackage: each takes (spark, sf_dir) and returns a DataFrame over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.llm import (
    bpe,
    collocations,
    decontaminate,
    jaccard,
    langid,
    licenses,
    packing,
    secret_scan,
    token_files,
    topk,
    toxicity,
    trie,
    warc,
)
from hazardlens.llm.storage import new_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark, sf_dir):
    """Secrets in all documents: three patterns, and runs of key characters with a high entropy."""
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark, sf_dir):
    """Pieces of all documents in sequences of at most 4096 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark, sf_dir):
    """Components of documents whose 4-word shingle sets have a similarity of 0.85 or more."""
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"), words=4, num=85, den=100)


def op4_token_files(spark, sf_dir):
    """Token ids of all documents, written to bit-packed files and read back."""
    folder = new_path(spark, "token-files")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), folder)
    return token_files.read_token_files(spark, folder)


def op5_toxicity(spark, sf_dir):
    """Toxicity of all documents, learnt from the labels of those that are not held out."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_language_id(spark, sf_dir):
    """Language of all documents, learnt from those that are not held out."""
    return langid.identify(_table(spark, sf_dir, "documents"))


def op7_license_scan(spark, sf_dir):
    """Licences that documents, or paragraphs or lines of them, are in whole."""
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op8_warc(spark, sf_dir):
    """Records of all pages, written to archives and read back."""
    return warc.round_trip(_table(spark, sf_dir, "pages")).drop("url")


def op9_exact_topk(spark, sf_dir):
    """The 10 highest inner products of every hundredth vector with all others."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op10_benchmark_decontamination(spark, sf_dir):
    """What part of each document lies in 13-word windows of benchmark items, and of which items."""
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op11_phrase_collocations(spark, sf_dir):
    """The 2000 phrases of two or three words of each language whose words belong together most."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_bpe_encoding(spark, sf_dir):
    """Digests of the ids of all documents, and of the texts that these ids decode to."""
    found = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_conversation_trie(spark, sf_dir):
    """The nodes of the prefix trie of all conversations, with totals of their subtrees."""
    return trie.prefix_trie(*trie.turn_paths(_table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_token_files": op4_token_files,
    "op5_toxicity": op5_toxicity,
    "op6_language_id": op6_language_id,
    "op7_license_scan": op7_license_scan,
    "op8_warc": op8_warc,
    "op9_exact_topk": op9_exact_topk,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_bpe_encoding": op12_bpe_encoding,
    "op13_conversation_trie": op13_conversation_trie,
}

_WARC_SQL = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
    FROM pages),
q AS (
    SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END
        AS latest
    FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN latest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN latest <> page_id THEN latest END AS refers_to
FROM q
"""

_TOP_K_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
found AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM found)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

_WORDS_SQL = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_BENCHMARK_SQL = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS_SQL} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS size,
           unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2), lambda i: w[i:i + least(13, len(w)) - 1])) AS win
    FROM items WHERE len(w) > 0),
docs AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS_SQL} AS w FROM documents),
first AS (SELECT DISTINCT size, win[1] AS word FROM windows),
places AS (SELECT row, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs),
spots AS (
    SELECT row, size, i, w[i:i + size - 1] AS win
    FROM places JOIN first USING (word) JOIN docs USING (row) WHERE i + size - 1 <= len(w)),
hits AS (SELECT row, i, spots.size, item_id FROM spots JOIN windows ON windows.win = spots.win),
hit_words AS (
    SELECT row, count(DISTINCT k) AS n_hit
    FROM (SELECT row, unnest(range(i, i + size)) AS k FROM (SELECT DISTINCT row, i, size FROM hits)) GROUP BY row),
hit_items AS (
    SELECT row, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
    FROM (SELECT DISTINCT row, item_id FROM hits) GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit_words USING (row) LEFT JOIN hit_items USING (row)
"""

_PHRASES_SQL = r"""
WITH lines AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS line
    FROM documents),
w AS (SELECT lang, regexp_extract_all(line, '[^\x20\x09]+') AS w FROM lines),
grams AS (
    SELECT lang, 1 AS size, unnest(w) AS phrase FROM w
    UNION ALL
    SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w
    UNION ALL
    SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    FROM w),
f AS (SELECT lang, size, phrase, count(*) AS c FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
cand AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS p, c AS a FROM f WHERE size > 1 AND c >= 10),
cuts AS (
    SELECT *, array_to_string(p[1:k], ' ') AS head, array_to_string(p[k + 1:], ' ') AS tail
    FROM (SELECT *, unnest(range(1, size)) AS k FROM cand)),
scored AS (
    SELECT cuts.lang, cuts.phrase, a, k, x.c AS l, y.c AS r,
           (1000000::HUGEINT * a * a) // (x.c::HUGEINT * y.c) AS score
    FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.head
              JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.tail),
lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
    SELECT lang, a AS outer_a, unnest([p[1] || ' ' || p[2], p[2] || ' ' || p[3]]) AS phrase FROM cand WHERE size = 3),
kept AS (
    SELECT * FROM lowest
    WHERE NOT EXISTS (
        SELECT 1 FROM inside WHERE inside.lang = lowest.lang AND inside.phrase = lowest.phrase AND 100 * outer_a >= 50 * a)),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

_TRIE_SQL = """
WITH crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
        CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS t),
turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT c, c - c % 100 AS base,
           xor(list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)),
               lambda s, b: xor(s // 256, t[xor(s, b) % 256 + 1]), 4294967295), 4294967295) % 6 AS h
    FROM (SELECT DISTINCT c FROM turns), crc),
given AS (SELECT convs.c, role, text, i FROM convs JOIN turns ON turns.c = base AND i <= h),
heads AS (SELECT c, count(*) AS b FROM given GROUP BY c),
path AS (
    SELECT * FROM given
    UNION ALL
    SELECT turns.c, role, text, i - h + coalesce(b, 0)
    FROM turns JOIN convs ON convs.c = turns.c LEFT JOIN heads ON heads.c = turns.c WHERE i > h),
steps AS (
    SELECT c, i AS d, length(text) AS n,
           sha256(string_agg(length(role) || ':' || length(text) || ':' || role || text, '')
               OVER (PARTITION BY c ORDER BY i)) AS node
    FROM path
    UNION ALL
    SELECT c, 0, 0, '' FROM convs),
ends AS (SELECT c, max(d) AS last FROM steps GROUP BY c),
nodes AS (
    SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
           sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = last), '')) AS ends_sha256
    FROM steps JOIN ends USING (c) GROUP BY node, d),
linked AS (
    SELECT nodes.*, up.node AS parent, upper.conv_id AS parent_conv_id
    FROM nodes LEFT JOIN steps up ON up.c = nodes.conv_id AND up.d = nodes.d - 1
               LEFT JOIN nodes upper ON upper.node = up.node AND upper.d = up.d),
children AS (SELECT parent, d - 1 AS d, count(*) AS k FROM linked WHERE d > 0 GROUP BY ALL),
counted AS (
    SELECT linked.*, coalesce(k, 0) AS n_children
    FROM linked LEFT JOIN children ON children.parent = linked.node AND children.d = linked.d),
totals AS (
    SELECT steps.node, steps.d, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
           sum((n_convs - 1) * counted.n) AS saved_tokens
    FROM counted JOIN steps ON steps.c = counted.conv_id AND steps.d <= counted.d GROUP BY ALL)
SELECT conv_id, counted.d AS depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM counted JOIN totals ON totals.node = counted.node AND totals.d = counted.d
"""

ORACLES: dict[str, str] = {
    "op8_warc": _WARC_SQL,
    "op9_exact_topk": _TOP_K_SQL,
    "op10_benchmark_decontamination": _BENCHMARK_SQL,
    "op11_phrase_collocations": _PHRASES_SQL,
    "op13_conversation_trie": _TRIE_SQL,
}
