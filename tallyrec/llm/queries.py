"""One query per operator: production parameters, whole tables, full results."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrec.llm import (
    centroids,
    chat,
    cosine,
    html_text,
    jaccard,
    language,
    licenses,
    merkle,
    packing,
    pieces,
    quality,
    topk,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")
CHAT_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: End id of a packed document, and the length of a sequence.
END_ID = 2
SEQUENCE = 4096
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


ROOT = str(Path(__file__).resolve().parents[2])


def workers_find_package(spark: SparkSession) -> None:
    """Python workers on this machine find the package wherever the driver was started."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes every text of documents."""
    return pieces.piece_digest(_table(spark, sf_dir, "documents"), "doc_id", "text", PIECE_MODEL)


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of five-word shingles link at 0.8."""
    joined = jaccard.jaccard_join(_table(spark, sf_dir, "documents"), "doc_id", "text")
    return joined.documents().drop("root")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document from a model of weak labels."""
    documents = _table(spark, sf_dir, "documents")
    model = quality.fit_quality(documents, "doc_id", "text")
    return quality.score_quality(documents, "doc_id", "text", model)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs all documents along a space-filling curve."""
    documents = _table(spark, sf_dir, "documents")
    return packing.pack(documents, "doc_id", "text", WORD_MODEL, END_ID, SEQUENCE).drop("ids")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract_pages(_table(spark, sf_dir, "pages"), "page_id", "url", "html")


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label linked at a cosine of 0.98, with their components."""
    return cosine.near_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside the held-out fold."""
    documents = _table(spark, sf_dir, "documents")
    model = language.fit_languages(documents, "doc_id", "text", "lang")
    found = language.predict_languages(documents, "doc_id", "text", model)
    return found.select(
        "doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score", "ambiguous"
    )


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best integer inner products of every fiftieth vector against all others."""
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_products(vectors, "vec_id", "embedding", F.col("id") % 50 == 0)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and template matches of every document."""
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.drop("matches")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats all conversations and one that imitates control strings; reads them back."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.read_back(chat.chat_forest(rows.union(own), CHAT_RANKS, public_tokenizers.PATTERN))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle tree over all documents by source; every leaf folded to the root, a fifth of them tampered with."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return merkle.build_manifest(
        _table(spark, sf_dir, "documents"),
        "doc_id",
        "source",
        ["doc_id", "source", "lang", "n_chars", "text"],
        changed={"text": F.translate("text", upper, lower)},
        where=F.crc32(F.col("doc_id").cast("string")) % 5 == 0,
    ).folds()


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages to WARC archives, equal payloads once, and reads the archives back."""
    found = warc.round_trip(_table(spark, sf_dir, "pages"), "page_id", "url", "html")
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after three rounds of exact integer k-means with 16 centroids."""
    found = centroids.cluster_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return found.drop("n_exact")


def llm_queries() -> dict[str, Query]:
    return {
        "op1_sentencepiece": op1_sentencepiece,
        "op2_jaccard": op2_jaccard,
        "op3_quality": op3_quality,
        "op4_packing": op4_packing,
        "op5_html": op5_html,
        "op6_near_vectors": op6_near_vectors,
        "op7_language": op7_language,
        "op8_topk": op8_topk,
        "op9_licenses": op9_licenses,
        "op10_chat": op10_chat,
        "op11_merkle": op11_merkle,
        "op12_warc": op12_warc,
        "op13_centroids": op13_centroids,
    }


#: floor(256 * x) of every usable vector, and the five best of every query.
_TOPK_SQL = """
WITH usable AS (
  SELECT vec_id,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


#: Shingle sets by list functions, links by an equi-join on shingles, components by recursion.
_JACCARD_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) END) AS s
  FROM split
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), link AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN size p ON p.doc_id = a.doc_id JOIN size q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n
  HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x
), component AS (
  SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x
)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN size z ON z.doc_id = d.doc_id JOIN component c ON c.doc_id = d.doc_id
"""

#: Cosines of all pairs with equal labels, components by recursion.
_COSINE_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS x, b.vec_id AS y
  FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION
  SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x
), component AS (
  SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x
), degree AS (
  SELECT x AS vec_id, count(*) AS n FROM link GROUP BY x
)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e LEFT JOIN degree d ON d.vec_id = e.vec_id JOIN component c ON c.vec_id = e.vec_id
"""


#: Trees by recursion, a level at a time; then every leaf climbs with its replacement and its siblings.
_MERKLE_SQL = """
WITH RECURSIVE tampered AS (
  SELECT *, xor(4294967295, list_reduce(
      list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) % 5 = 0 AS hit,
    coalesce('=' || source, '') AS tree,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text
  FROM documents
), hashed AS (
  SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(lower_text) || ':' || lower_text, '-')) AS other, coalesce(hit, false) AS hit
  FROM tampered
), leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS n, row_number() OVER () AS id
  FROM hashed
), node AS (
  SELECT tree, 0 AS level, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 16, (max(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY pos))
  FROM node WHERE n > 1 GROUP BY tree, level, pos // 16
), subroot AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1
), upper AS (
  SELECT 0 AS level, pos, n, h FROM subroot
  UNION ALL
  SELECT level + 1, pos // 16, (max(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY pos))
  FROM upper WHERE n > 1 GROUP BY level, pos // 16
), run AS (
  SELECT tree, level, pos // 16 AS parent, list(h ORDER BY pos) AS h FROM node WHERE n > 1 GROUP BY tree, level, pos // 16
), upper_run AS (
  SELECT level, pos // 16 AS parent, list(h ORDER BY pos) AS h FROM upper WHERE n > 1 GROUP BY level, pos // 16
), climb AS (
  SELECT id, tree, 0 AS level, pos, CASE WHEN hit THEN other ELSE leaf END AS folded, '' AS proof FROM leaves
  UNION ALL
  SELECT c.id, c.tree, c.level + 1, c.pos // 16,
    sha256(array_to_string(list_concat(list_concat(r.h[1:c.pos % 16], [c.folded]), r.h[c.pos % 16 + 2:]), '')),
    c.proof || array_to_string(list_concat(r.h[1:c.pos % 16], r.h[c.pos % 16 + 2:]), '')
  FROM climb c JOIN run r ON r.tree = c.tree AND r.level = c.level AND r.parent = c.pos // 16
), top_climb AS (
  SELECT c.id, 0 AS level, s.pos, c.folded, c.proof
  FROM (SELECT * FROM climb QUALIFY row_number() OVER (PARTITION BY id ORDER BY level DESC) = 1) c
  JOIN subroot s ON s.tree = c.tree
  UNION ALL
  SELECT c.id, c.level + 1, c.pos // 16,
    sha256(array_to_string(list_concat(list_concat(r.h[1:c.pos % 16], [c.folded]), r.h[c.pos % 16 + 2:]), '')),
    c.proof || array_to_string(list_concat(r.h[1:c.pos % 16], r.h[c.pos % 16 + 2:]), '')
  FROM top_climb c JOIN upper_run r ON r.level = c.level AND r.parent = c.pos // 16
)
SELECT l.doc_id, l.leaf, s.h AS subroot, u.h AS root, sha256(t.proof) AS proof_sha256, t.folded AS folded_root,
  t.folded = u.h AS verified
FROM leaves l
JOIN subroot s ON s.tree = l.tree
JOIN (SELECT * FROM top_climb QUALIFY row_number() OVER (PARTITION BY id ORDER BY level DESC) = 1) t ON t.id = l.id
CROSS JOIN (SELECT h FROM upper WHERE n = 1) u
"""


#: SHA-1 by DuckDB, its bytes as bits in groups of five.
_WARC_SQL = """
WITH page AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, coalesce(html, '') AS payload,
         sha1(coalesce(html, '')) AS digest
  FROM pages
), first AS (
  SELECT payload, min(page_id) AS first FROM page GROUP BY payload
)
SELECT p.page_id, p.payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda g:
         list_aggregate(list_transform(range(0, 5), lambda b:
           ((strpos('0123456789abcdef', p.digest[(5 * g + b) // 4 + 1]) - 1) // CAST(2 ** (3 - (5 * g + b) % 4) AS INTEGER) % 2)
             * CAST(2 ** (4 - b) AS INTEGER)), 'sum')), ',') AS groups,
       CASE WHEN p.page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id <> f.first THEN f.first END AS refers_to
FROM page p JOIN first f ON f.payload = p.payload
"""
_WARC_SQL = f"""
SELECT page_id, payload_bytes,
       array_to_string(list_transform(string_split(groups, ','),
         lambda x: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[CAST(x AS INTEGER) + 1]), '') AS payload_digest,
       record_type, refers_to
FROM ({_WARC_SQL})
"""


def _centroid_sql(rounds: int = 3, k: int = 16) -> str:
    """Squared distances of every vector to every centroid, a pair of subqueries per round."""
    nearest = """
  SELECT vec_id, v, cluster, distance FROM (
    SELECT x.vec_id, x.v, c.cluster, x.place,
           CAST(list_sum(list_transform(range(1, 65), lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i]))) AS BIGINT) AS distance
    FROM kept x CROSS JOIN centre{r} c
  ) QUALIFY row_number() OVER (PARTITION BY place ORDER BY distance, cluster) = 1"""
    parts = [
        """kept AS (
  SELECT row_number() OVER () AS place, vec_id,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""centre0 AS (
  SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), v) - 1 AS INTEGER) AS cluster, v
  FROM kept QUALIFY cluster < {k}
)""",
    ]
    for r in range(rounds):
        parts += [
            f"near{r} AS ({nearest.format(r=r)}\n)",
            f"""mean{r} AS (
  SELECT cluster, list(floored ORDER BY i) AS v FROM (
    SELECT cluster, i, (s - ((s % n) + n) % n) // n AS floored FROM (
      SELECT cluster, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
      FROM near{r} CROSS JOIN (SELECT unnest(range(1, 65)) AS i) GROUP BY cluster, i)
  ) GROUP BY cluster
)""",
            f"""centre{r + 1} AS (
  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM centre{r} c LEFT JOIN mean{r} m ON m.cluster = c.cluster
)""",
        ]
    return (
        "WITH "
        + ", ".join(f"{p.split(' AS ', 1)[0]} AS MATERIALIZED {p.split(' AS ', 1)[1]}" for p in parts)
        + f""", last AS ({nearest.format(r=rounds)}
)
SELECT l.vec_id, l.cluster, l.distance,
       CAST(sum(l.distance) OVER (PARTITION BY l.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(l.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM last l JOIN centre{rounds} c ON c.cluster = l.cluster
"""
    )


def llm_oracles() -> dict[str, str]:
    return {
        "op2_jaccard": _JACCARD_SQL,
        "op6_near_vectors": _COSINE_SQL,
        "op8_topk": _TOPK_SQL,
        "op11_merkle": _MERKLE_SQL,
        "op12_warc": _WARC_SQL,
        "op13_centroids": _centroid_sql(),
    }
