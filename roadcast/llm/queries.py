"""The registered queries of this package and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .bpe import tokenize
from .common import load
from .filter_audit import audit
from .grace_dedup import grace_dedup
from .language import fit, identify
from .line_chunks import digests, line_dedup
from .minhash import near_duplicates
from .mixing import mix
from .pii import find_pii
from .prefix_trie import trie
from .repeats import remove_repeats
from .sharding import shard_by_bytes
from .topk import topk
from .warc import page_records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


@query("op1_language_filters")
def op1_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return identify(docs, fit(docs))


@query("op2_grace_dedup", r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)""")
def op2_grace_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grace_dedup(load(spark, sf_dir, "documents"))


@query("op3_bpe_transducer")
def op3_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), readable=True)


@query("op4_dual_cover_tree", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, vec_id, score,
             row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op4_dual_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk(load(spark, sf_dir, "embeddings"))


@query("op5_bayes_minhash")
def op5_bayes_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents"), width=4).drop("n_links", "k1", "k2", "stays")


@query("op6_line_chunks")
def op6_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(line_dedup(load(spark, sf_dir, "documents"), runs=True))


@query("op7_disclosure_pii")
def op7_disclosure_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(load(spark, sf_dir, "documents")).drop("found")


@query("op8_source_schedule")
def op8_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(load(spark, sf_dir, "documents")).drop("first", "second")


@query("op9_sampled_splitters")
def op9_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(load(spark, sf_dir, "documents"))


@query("op10_run_length_index")
def op10_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(load(spark, sf_dir, "documents"))


@query("op11_prefix_trie", """
WITH k AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(list_prepend(4294967295,
        list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda a, b: xor(a >> 8, tab[1 + (xor(a, b) & 255)]))) % 6 AS h
      FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), k),
o AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS p FROM conversations),
r AS (SELECT c.conv_id, 0 AS own, p, r, t FROM c JOIN o ON o.conv_id = c.base AND p < h
      UNION ALL SELECT c.conv_id, 1, p, r, t FROM c JOIN o ON o.conv_id = c.conv_id AND p >= h),
s AS (SELECT conv_id, list(md5(length(r) || ':' || r || t) ORDER BY own, p) AS e, list(length(t) ORDER BY own, p) AS l
      FROM r GROUP BY 1),
w AS (SELECT c.conv_id, coalesce(e, []) AS e, coalesce(l, []) AS l FROM c LEFT JOIN s USING (conv_id)),
x AS (SELECT conv_id, e, l, len(e) AS n, unnest(range(len(e) + 1)) AS depth FROM w),
g AS (SELECT array_to_string(e[1:depth], '') AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             coalesce(any_value(l[depth]), 0) AS chars,
             coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '') AS ends FROM x GROUP BY 1, 2),
y AS (SELECT substr(path, 1, 32 * (depth - 1)::INT) AS path, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY 1),
z AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN y USING (path)),
a AS (SELECT substr(path, 1, 32 * k) AS path, sum((n_convs - 1) * chars) AS saved, count(*) FILTER (n_children = 0) AS leaves
      FROM (SELECT *, unnest(range(depth + 1))::INT AS k FROM z) GROUP BY 1)
SELECT z.conv_id, z.depth, u.conv_id AS parent_conv_id, z.n_convs, z.n_children, leaves AS n_leaves,
       saved::BIGINT AS saved_tokens, sha256(z.ends) AS ends_sha256
FROM z JOIN a USING (path) LEFT JOIN z u ON z.depth > 0 AND u.path = substr(z.path, 1, 32 * (z.depth - 1)::INT)""")
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(load(spark, sf_dir, "conversations"))


@query("op12_filter_audit", r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
f AS (SELECT doc_id, part, CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
c AS (SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS before
      FROM o, (SELECT unnest(range(1, 6))::INT AS step)),
r AS (SELECT part, filter_order, step, letter, fails, n, good, toxic, contains(fails, letter) AS bad,
             before <> '' AND regexp_matches(fails, '[' || before || 'x]') AS gone FROM c, s),
g AS (SELECT part, filter_order, step, letter,
             coalesce(sum(n) FILTER (NOT bad AND NOT gone), 0)::BIGINT AS kept,
             coalesce(sum(n) FILTER (bad AND NOT gone), 0)::BIGINT AS removed,
             coalesce(sum(n) FILTER (bad AND gone), 0)::BIGINT AS redundant,
             coalesce(sum(n) FILTER (fails = letter), 0)::BIGINT AS unique_fails,
             coalesce(sum(good) FILTER (bad AND NOT gone), 0)::BIGINT AS good_lost,
             coalesce(sum(toxic) FILTER (bad AND NOT gone), 0)::BIGINT AS toxic_lost
      FROM r GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM g""")
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query("op13_warc_records", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS x FROM p),
f AS (SELECT page_id, n, x, min(page_id) OVER (PARTITION BY x) AS first FROM h),
-- ten hex digits are 40 bits, eight letters of base32
d AS (SELECT x, list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
          1 + ((('0x' || substr(x, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT, 1)),
          'string_agg', '') AS digest FROM (SELECT DISTINCT x FROM h))
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f JOIN d USING (x)""")
def op13_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_records(load(spark, sf_dir, "pages"))
