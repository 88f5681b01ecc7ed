"""Queries of the training-data operators over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tristrata.llm import (
    decontaminate,
    divergence,
    extract,
    fixity,
    hnsw,
    kdtree,
    licenses,
    near,
    packing,
    quality,
    toxicity,
    trie,
    urls,
)


def _given(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_two_fit_packing(spark, sf_dir):
    return packing.packed_sequences(_given(spark, sf_dir, "documents"))


def op2_url_filter(spark, sf_dir):
    return urls.filter_urls(_given(spark, sf_dir, "pages"))


def op3_template_decontamination(spark, sf_dir):
    documents = _given(spark, sf_dir, "documents")
    return decontaminate.leaks(documents, _given(spark, sf_dir, "benchmark")).drop("place")


def op4_quality_classifier(spark, sf_dir):
    documents = _given(spark, sf_dir, "documents")
    return quality.quality_scores(documents, _given(spark, sf_dir, "labels"))


def op5_small_world_neighbours(spark, sf_dir):
    return hnsw.nearest_neighbours(_given(spark, sf_dir, "embeddings"))


def op6_kd_tree_sharding(spark, sf_dir):
    return kdtree.kd_shards(_given(spark, sf_dir, "documents"))


def op7_merkle_fixity(spark, sf_dir):
    """The archive of all pages against a replica with damage by rule: some records with
    another byte, some lost."""
    pages = _given(spark, sf_dir, "pages")
    ours = fixity.digests(fixity.warc_records(pages))
    altered = F.when(
        F.col("page_id") % 50 == 7, F.concat(F.lit("#"), F.substring("html", 2, 1 << 30))
    ).otherwise(F.col("html"))
    damaged = pages.where("page_id % 100 <> 61").withColumn("html", altered)
    theirs = fixity.digests(fixity.warc_records(damaged))
    return fixity.audit(fixity.manifest(ours), fixity.manifest(theirs))


def op8_patience_licenses(spark, sf_dir):
    return licenses.license_spans(_given(spark, sf_dir, "documents"))


def op9_parity_sketch_join(spark, sf_dir):
    return near.near_components(_given(spark, sf_dir, "documents"))


def op10_block_labeller(spark, sf_dir):
    return extract.main_text(_given(spark, sf_dir, "pages"))


def op11_counterfactual_toxicity(spark, sf_dir):
    documents = _given(spark, sf_dir, "documents")
    return toxicity.toxicity_scores(documents, _given(spark, sf_dir, "labels"))


def op12_van_emde_boas_trie(spark, sf_dir):
    return trie.prefix_trie(_given(spark, sf_dir, "conversations"))


def op13_row_accumulation_divergence(spark, sf_dir):
    return divergence.divergences(_given(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_two_fit_packing,
        op2_url_filter,
        op3_template_decontamination,
        op4_quality_classifier,
        op5_small_world_neighbours,
        op6_kd_tree_sharding,
        op7_merkle_fixity,
        op8_patience_licenses,
        op9_parity_sketch_join,
        op10_block_labeller,
        op11_counterfactual_toxicity,
        op12_van_emde_boas_trie,
        op13_row_accumulation_divergence,
    )
}

_FIXITY = """
WITH ours AS (
  SELECT page_id, page_id // 1000 AS archive,
    strlen('WARC/1.0..WARC-Type: resource..WARC-Record-ID: <urn:page:') + strlen(page_id::VARCHAR)
    + strlen('>..WARC-Target-URI: ') + strlen(url)
    + strlen('..Content-Type: text/html..Content-Length: ')
    + strlen(strlen(html)::VARCHAR) + 8 + strlen(html) AS length,
    page_id % 100 = 61 AS lost,
    page_id % 50 = 7 AND html NOT LIKE '#%' AS hurt,
    CASE WHEN page_id % 50 = 7 THEN
      strlen('#' || substr(html, 2)) - strlen(html) ELSE 0 END AS grown
  FROM pages),
theirs AS (SELECT *, length + grown AS their_length FROM ours),
placed AS (
  SELECT *,
    coalesce(sum(length) OVER (PARTITION BY archive ORDER BY page_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset",
    coalesce(sum(CASE WHEN lost THEN 0 ELSE their_length END) OVER (PARTITION BY archive
      ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS other
  FROM theirs)
SELECT archive, 0::BIGINT AS part, page_id,
  CASE WHEN lost THEN 'missing' WHEN hurt THEN 'altered' ELSE 'moved' END AS status,
  "offset"::BIGINT AS "offset", length::BIGINT AS length,
  CASE WHEN NOT lost THEN other::BIGINT END AS their_offset,
  CASE WHEN NOT lost THEN their_length::BIGINT END AS their_length
FROM placed WHERE lost OR hurt OR "offset" <> other
"""

_NEAR = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS i
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT u, v FROM common JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
  WHERE 100 * i >= 90 * (x.n + y.n - i)),
edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (
  SELECT u AS doc_id, u AS low FROM edges
  UNION
  SELECT e.v, r.low FROM reach r JOIN edges e ON e.u = r.doc_id WHERE r.low < e.v)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(low, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT doc_id, min(low) AS low FROM reach GROUP BY doc_id) USING (doc_id)
"""

_TRIE = """
WITH RECURSIVE convs AS (
  SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
bits AS (
  -- CRC-32 of the decimal id, bit by bit.
  SELECT c, c::VARCHAR AS id, 0 AS k, 4294967295::BIGINT AS crc FROM convs
  UNION ALL
  SELECT c, id, k + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
  FROM (SELECT c, id, k, CASE WHEN k % 8 = 0 THEN xor(crc, ord(id[k // 8 + 1])) ELSE crc END AS x
        FROM bits WHERE k < 8 * len(id))),
heads AS (
  SELECT c, xor(crc, 4294967295) % 6 AS h FROM bits WHERE k = 8 * len(id)),
rebuilt AS (
  SELECT a.c, list_concat(coalesce(b.turns, [])[1:h], a.turns[h + 1:]) AS turns
  FROM convs a JOIN heads USING (c) LEFT JOIN convs b ON b.c = a.c - a.c % 100),
paths AS (
  SELECT c, len(turns) AS size, unnest(range(len(turns) + 1)) AS depth, turns FROM rebuilt),
steps AS (
  SELECT c, depth, size = depth AS ending, turns[:depth] AS prefix,
    CASE WHEN depth > 0 THEN turns[:depth - 1] END AS above,
    CASE WHEN depth > 0 THEN len(turns[depth].t) ELSE 0 END AS chars
  FROM paths),
nodes AS (
  SELECT prefix, depth, any_value(above) AS above, min(c) AS conv_id, count(*) AS n,
    (count(*) - 1) * any_value(chars) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ending), '')) AS sha
  FROM steps GROUP BY prefix, depth),
children AS (SELECT above AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY above),
marked AS (
  SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (prefix)),
under AS (
  SELECT prefix[:d] AS prefix, saved, n_children = 0 AS leaf
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM marked)),
sums AS (
  SELECT prefix, sum(saved)::BIGINT AS saved, count(*) FILTER (WHERE leaf) AS leaves
  FROM under GROUP BY prefix)
SELECT m.conv_id, m.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, m.n AS n_convs,
  m.n_children, s.leaves AS n_leaves, s.saved AS saved_tokens, m.sha AS ends_sha256
FROM marked m JOIN sums s ON s.prefix = m.prefix LEFT JOIN nodes p ON p.prefix = m.above
"""

_DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
words AS (
  SELECT r, lang, source,
    unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs),
kept AS (
  SELECT lang, term, count(*) AS ln FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(ln) AS n FROM kept GROUP BY lang),
counts AS (
  SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
grouped AS (SELECT DISTINCT lang, source FROM docs),
totals AS (
  SELECT lang, source, coalesce(sum(c), 0) AS n FROM grouped LEFT JOIN counts USING (lang, source)
  GROUP BY ALL),
cells AS (
  SELECT lang, source, term, coalesce(c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(c, 0) + 1)) // (t.n::HUGEINT + v) AS p,
    1 + (1000000000::HUGEINT * (ln + 1)) // (l.n::HUGEINT + v) AS q
  FROM totals t JOIN kept USING (lang) JOIN langs l USING (lang)
  LEFT JOIN counts USING (lang, source, term)),
summed AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM grouped a JOIN grouped b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
  FROM cells WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part
    ORDER BY value DESC, encode(item)))::INTEGER AS rank
  FROM (FROM pairs UNION ALL FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""

ORACLES = {
    "op7_merkle_fixity": _FIXITY,
    "op9_parity_sketch_join": _NEAR,
    "op12_van_emde_boas_trie": _TRIE,
    "op13_row_accumulation_divergence": _DIVERGENCE,
}
