"""The registered queries of this package and the SQL that some of them must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    classifier,
    decontaminate,
    near_duplicates,
    packing,
    preferences,
    prefix_bpe,
    quality,
    runs,
    secrets,
    shallot,
    substrings,
    suffixes,
    token_counts,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_relative_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.remove_repeats(table(spark, sf_dir, "documents")))


@_query
def op2_suffix_radix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(suffixes.remove_repeats(table(spark, sf_dir, "documents")))


@_query
def op3_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(table(spark, sf_dir, "documents"))


@_query
def op4_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.by_limit(token_counts.histogram(table(spark, sf_dir, "documents")))


@_query
def op5_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"))


@_query
def op6_first_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@_query
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


@_query
def op8_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.format_pairs(preferences.swapped_replies(table(spark, sf_dir, "conversations")))


@_query
def op9_byte_convolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = classifier.train(docs, table(spark, sf_dir, "labels"))
    return classifier.digest(classifier.score(docs, network))


ORACLES["op7_benchmark_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (
  SELECT DISTINCT item, least(len(w), 13) AS k, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
g AS (
  SELECT rid, k, i, array_to_string(w[i : i + k - 1], ' ') AS win
  FROM (SELECT d.rid, d.w, s.k, unnest(range(1, len(d.w) - s.k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM p) s)),
h AS (SELECT g.rid, g.i, g.k, p.item FROM g JOIN p ON g.win = p.win AND g.k = p.k),
n AS (SELECT rid, count(DISTINCT x) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS x FROM h) GROUP BY rid),
t AS (SELECT rid, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item) FILTER (item IS NOT NULL)), ',') AS items FROM h GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256,
       coalesce(n.n_hit, 0) > 0 AND 20 * coalesce(n.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN n ON d.rid = n.rid LEFT JOIN t ON d.rid = t.rid
"""


@_query
def op10_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secrets.scan(table(spark, sf_dir, "documents"))
    return secrets.digest(found)


_SECRET_SQL = {name: f"'{getattr(secrets, name.upper()).pattern.replace(chr(39), chr(39) * 2)}'" for name in secrets.KINDS}
_SECRET_PARTS = " UNION ALL ".join(
    f"SELECT rid, {k} AS k, regexp_extract_all(t, {p}) AS m, string_split_regex(t, {p}) AS g FROM d"
    for k, p in enumerate(_SECRET_SQL.values())
)
ORACLES["op10_secret_ledger"] = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({_SECRET_PARTS}),
p AS (
  SELECT rid, k, m[i] AS x, CAST(list_sum(list_transform(g[1:i], lambda y: length(y)))
         + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: length(y))), 0) AS BIGINT) AS a
  FROM (SELECT rid, k, m, g, unnest(range(1, len(m) + 1)) AS i FROM m)),
s AS (SELECT rid, k, a, (['assign', 'access', 'hex', 'pem'])[k + 1] || ':' || a || ':' || (a + length(x)) AS span
      FROM p WHERE k <> 0 OR length(regexp_extract(x, {_SECRET_SQL["assign"]}, 1)) >= 6),
r AS (SELECT rid, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
             string_agg(span, ',' ORDER BY a, k) FILTER (k < 3) AS base, string_agg(span, ',' ORDER BY a, k) AS spans FROM s GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN r ON d.rid = r.rid
"""

ORACLES["op8_preference_pairs"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS own FROM t GROUP BY conv_id),
k AS (
  SELECT conv_id, own, len(own) - coalesce(list_position(list_reverse(list_transform(own, lambda x: x.role = 'assistant')), true), 0) AS kept,
         list_filter(own, lambda x: x.role = 'assistant')[-1:] AS reply FROM c),
p AS (
  SELECT k.conv_id AS pair_id, k.own AS a, list_concat(k.own[1:k.kept], coalesce(o.reply, [])) AS b
  FROM k LEFT JOIN k o ON o.conv_id = CASE WHEN ((k.conv_id % 2) + 2) % 2 = 0 THEN k.conv_id + 1 ELSE k.conv_id - 1 END),
n AS (
  SELECT pair_id, a, b, coalesce(list_min(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[i] <> b[i])) - 1, least(len(a), len(b))) AS n FROM p),
r AS (SELECT pair_id, n, a[1:n] AS p, a[n + 1:] AS c, b[n + 1:] AS d FROM n),
x AS (
  SELECT pair_id, n, array_to_string(list_transform(p, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || chr(10)), '') AS prompt,
    list_transform(c, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || chr(10)) AS c1, c,
    list_transform(d, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || chr(10)) AS d1, d FROM r)
SELECT pair_id, CAST(n AS BIGINT) AS n_prompt, prompt, array_to_string(c1, '') AS chosen, array_to_string(d1, '') AS rejected,
  array_to_string(list_transform(list_filter(range(1, len(c) + 1), lambda i: c[i].role = 'assistant'), lambda i:
    CAST(CAST(length(array_to_string(c1[1:i], '')) - length(c[i].text) - 1 AS BIGINT) AS VARCHAR) || ':' || CAST(length(array_to_string(c1[1:i], '')) AS VARCHAR)), ',') AS chosen_mask,
  array_to_string(list_transform(list_filter(range(1, len(d) + 1), lambda i: d[i].role = 'assistant'), lambda i:
    CAST(CAST(length(array_to_string(d1[1:i], '')) - length(d[i].text) - 1 AS BIGINT) AS VARCHAR) || ':' || CAST(length(array_to_string(d1[1:i], '')) AS VARCHAR)), ',') AS rejected_mask
FROM x
"""

ORACLES["op1_relative_lempel_ziv"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
h AS (SELECT rid, doc_id, list_transform(range(1, len(w) - 48), lambda i: md5(array_to_string(w[i : i + 49], ' '))) AS hs FROM d WHERE len(w) >= 50),
g AS (SELECT rid, doc_id, unnest(hs) AS h, unnest(range(1, len(hs) + 1)) AS i FROM h),
f AS (SELECT h, min(doc_id) AS m FROM g GROUP BY h),
x AS (SELECT DISTINCT rid, unnest(range(i, i + 50)) AS p FROM g JOIN f ON g.h = f.h WHERE m < doc_id),
r AS (SELECT rid, count(*) AS n, list(p) AS gone FROM x GROUP BY rid),
u AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (SELECT u.rid, string_agg(word, ' ' ORDER BY u.p) AS kept FROM u ANTI JOIN x ON u.rid = x.rid AND u.p = x.p GROUP BY u.rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r ON d.rid = r.rid LEFT JOIN k ON d.rid = k.rid
"""


@_query
def op11_shallot_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shallot.digest(*shallot.cluster(table(spark, sf_dir, "embeddings")))


# The rounds one after the other; squared distances are exact in doubles under 2**53.
_MEANS = """
a{r} AS MATERIALIZED (
  SELECT rid, vec_id, v, arg_min(c, {{'d': d, 'c': c}}) AS c, min(d) AS d
  FROM (SELECT v.rid, v.vec_id, v.v, m.c, CAST(list_inner_product(v.v, v.v) - 2 * list_inner_product(v.v, m.v) + list_inner_product(m.v, m.v) AS BIGINT) AS d
        FROM kept v CROSS JOIN m{r} m) GROUP BY rid, vec_id, v),
s{r} AS (
  SELECT c, list(CAST(floor(s / n) AS DOUBLE) ORDER BY i) AS v
  FROM (SELECT c, i, sum(CAST(x AS BIGINT)) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS i FROM a{r}) GROUP BY c, i) GROUP BY c),
m{next} AS MATERIALIZED (SELECT m.c, coalesce(s.v, m.v) AS v FROM m{r} m LEFT JOIN s{r} s ON m.c = s.c),"""
_LAST = _MEANS.partition("),\ns{r}")[0].format(r=10) + ")"
ORACLES["op11_shallot_clustering"] = rf"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
m0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS INTEGER) AS c, v
  FROM (SELECT vec_id, v FROM kept WHERE vec_id IS NOT NULL ORDER BY sha256('3:' || vec_id) LIMIT 8)),
{"".join(_MEANS.format(r=r, next=r + 1) for r in range(10))}
{_LAST}
SELECT a.vec_id, a.c AS cluster, a.d AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(m.v, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM a10 a JOIN m10 m ON a.c = m.c
"""


@_query
def op12_prefix_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.digest(prefix_bpe.round_trip(table(spark, sf_dir, "documents")))


@_query
def op13_recompression_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.find_runs(runs.with_periodic_tails(table(spark, sf_dir, "documents"))))
