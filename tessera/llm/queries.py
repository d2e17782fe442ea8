"""The queries of the corpus operators: each applies its operator, with
production parameters, to its whole table and shapes the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _mix_sql(table_name: str = "documents", passes: int = 3) -> str:
    """The mix in SQL: running sums along the hash line instead of histograms."""
    ctes = [f"""
sizes AS (SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
  CAST('0x' || substr(md5(COALESCE(CAST(doc_id AS VARCHAR), 'null') || '|mix'), 1, 15) AS BIGINT) AS line FROM {table_name}),
per_source AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
caps AS (SELECT *, source_size * 3 AS cap, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight FROM per_source),
levels AS (SELECT *, cap / weight AS cap_level,
  (SUM(source_size) OVER () - COALESCE(SUM(cap) OVER before, 0)) / (SUM(weight) OVER () - COALESCE(SUM(weight) OVER before, 0)) AS level
  FROM caps WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, LEAST(CAST(cap AS DOUBLE),
  (SELECT MAX(level) FROM levels WHERE cap_level >= level) * weight) AS target FROM levels),
planned AS (SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS whole FROM targets),
left0 AS (SELECT s.*, t.source_size, t.target, t.whole, t.target - t.whole * t.source_size AS gap, FALSE AS extra
  FROM sizes s JOIN planned t ON s.source IS NOT DISTINCT FROM t.source)"""]
    for k in range(passes):
        ctes.append(f"""
run{k} AS (SELECT *, SUM(CASE WHEN NOT extra AND size > 0 AND size <= gap THEN size ELSE 0 END)
  OVER (PARTITION BY source ORDER BY line RANGE UNBOUNDED PRECEDING) AS upto FROM left{k}),
took{k} AS (SELECT * EXCLUDE (upto), NOT extra AND size > 0 AND size <= gap AND upto <= gap AS now FROM run{k}),
left{k + 1} AS (SELECT * EXCLUDE (now, extra, gap), extra OR now AS extra,
  gap - SUM(CASE WHEN now THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap FROM took{k})""")
    ctes.append(f"""
places AS (SELECT source, line, ANY_VALUE(gap) AS gap, abs(SUM(size) - ANY_VALUE(gap)) AS off FROM left{passes}
  WHERE NOT extra AND size > 0 AND size < 2 * gap GROUP BY source, line),
nearest AS (SELECT source, arg_min(line, (off, line)) AS pick FROM places WHERE off < gap GROUP BY source)""")
    return "WITH " + ",".join(ctes) + f"""
SELECT doc_id, size, source_size, target, size * (whole + CAST(extra OR COALESCE(size > 0 AND line = pick, FALSE) AS BIGINT)) AS taken
FROM left{passes} l LEFT JOIN nearest n ON l.source IS NOT DISTINCT FROM n.source"""


@query("op8_mixing", _mix_sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to the mix of all sources (weights 1, 2, 3; at most 3 epochs)."""
    from .mixing import mix
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def tokenizer_path() -> str:
    """The public vocabulary that the packing contract names."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    from .packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op7_language")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by hyperdimensional profiles."""
    from .language import identify_corpus
    return identify_corpus(table(spark, sf_dir, "documents"))


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, by a factorization machine over hashed terms."""
    from .toxicity import score_corpus
    return score_corpus(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def query_ids() -> Column:
    """The stated query set of the searches: every fiftieth id, against all rows."""
    return F.col("vec_id") % 50 == 0


@query("op2_neighbours")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every fiftieth, by cross-polytope hashing and exact cosines."""
    from .neighbours import nearest
    return nearest(table(spark, sf_dir, "embeddings"), query_ids())


@query("op6_topk", """
WITH usable AS (SELECT row_number() OVER () AS n, vec_id, [CAST(x AS DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scaled AS MATERIALIZED (SELECT n, vec_id, [floor(256 * x) for x in v] AS v FROM usable),
scored AS (SELECT q.n, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM scaled q JOIN scaled c ON q.n <> c.n WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) <= 5""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 largest whole-number inner products of every fiftieth vector, by block-at-a-time pruning."""
    from .topk import top_products
    return top_products(table(spark, sf_dir, "embeddings"), query_ids())


@query("op3_chat", """
WITH said AS (SELECT conv_id, turn, COALESCE(role, 'unknown') AS speaker, COALESCE(text, '') AS said FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS participant FROM said WHERE speaker <> 'system'),
views AS (SELECT s.*, p.participant, CASE WHEN s.speaker = p.participant THEN '<|im_start|>assistant' || chr(10)
    WHEN s.speaker = 'system' THEN '<|im_start|>system' || chr(10)
    ELSE '<|im_start|>user name=' || s.speaker || chr(10) END AS header
  FROM said s JOIN people p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
segments AS (SELECT *, header || said || '<|im_end|>' || chr(10) AS segment FROM views),
placed AS (SELECT *, CAST(SUM(length(segment)) OVER w AS BIGINT) AS stop, row_number() OVER w - 1 AS position FROM segments
  WINDOW w AS (PARTITION BY conv_id, participant ORDER BY turn NULLS FIRST, speaker, said ROWS UNBOUNDED PRECEDING))
SELECT conv_id, participant, position, turn, speaker, segment, stop - length(segment) AS start, stop,
  CAST(speaker = participant AS INTEGER) AS mask,
  CASE WHEN speaker = participant THEN stop - length(segment) + length(header) END AS mask_start,
  CASE WHEN speaker = participant THEN stop END AS mask_stop
FROM placed""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from every participant's perspective, with masks."""
    from .chat import perspectives
    return perspectives(table(spark, sf_dir, "conversations"))


@query("op5_pages")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    from .pages import main_texts
    return main_texts(table(spark, sf_dir, "pages")) \
        .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_repeated")


@query("op1_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents (4-word shingles, similarity 0.8)."""
    from .near_dedup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), words=4)


@query("op4_repeats")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that earlier 100-byte strings repeat."""
    from .suffixes import repeated_bytes
    return repeated_bytes(table(spark, sf_dir, "documents"))


@query("op11_merkle", """
WITH RECURSIVE
fields AS (SELECT doc_id, lang, CAST(n_chars AS BIGINT) AS n_chars, COALESCE(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
    || COALESCE(octet_length(encode(source)) || ':' || source, '-') || COALESCE(octet_length(encode(lang)) || ':' || lang, '-') AS head,
  COALESCE(octet_length(encode(text)) || ':' || text, '-') AS tail,
  list_reduce([x for x in range(8 * COALESCE(len(CAST(doc_id AS VARCHAR)), 0))], lambda c, k:
    (CASE WHEN xor(c, CASE WHEN k % 8 = 0 THEN ascii(CAST(doc_id AS VARCHAR)[k // 8 + 1]) ELSE 0 END) & 1 = 1 THEN xor(3988292384,
       xor(c, CASE WHEN k % 8 = 0 THEN ascii(CAST(doc_id AS VARCHAR)[k // 8 + 1]) ELSE 0 END) >> 1)
     ELSE xor(c, CASE WHEN k % 8 = 0 THEN ascii(CAST(doc_id AS VARCHAR)[k // 8 + 1]) ELSE 0 END) >> 1 END), CAST(4294967295 AS BIGINT)) AS crc
  FROM documents),
hashed AS (SELECT doc_id, lang, sha256(head || COALESCE(len(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
  CASE WHEN doc_id IS NOT NULL AND xor(crc, 4294967295) % 7 = 0
    THEN sha256(head || COALESCE(len(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) END AS tampered FROM fields),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM hashed),
low AS (SELECT lang, 0 AS level, idx, leaf AS digest, COUNT(*) OVER (PARTITION BY lang) AS members FROM placed
  UNION ALL SELECT lang, level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (ANY_VALUE(members) + 1) // 2 FROM low
  WHERE members > 1 GROUP BY lang, level, idx // 2),
subroots AS (SELECT lang, level AS height, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx FROM low WHERE members = 1),
high AS (SELECT 0 AS level, idx, digest, COUNT(*) OVER () AS members FROM subroots
  UNION ALL SELECT level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (ANY_VALUE(members) + 1) // 2 FROM high
  WHERE members > 1 GROUP BY level, idx // 2),
climb AS (SELECT p.doc_id, p.leaf, p.lang, p.idx, s.height, s.digest AS subroot, s.idx AS place, 0 AS step, '' AS proof, COALESCE(p.tampered, p.leaf) AS folded
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT c.doc_id, c.leaf, c.lang, CASE WHEN c.step < c.height THEN c.idx // 2 ELSE c.idx END, c.height, c.subroot,
    CASE WHEN c.step < c.height THEN c.place ELSE c.place // 2 END, c.step + 1, c.proof || COALESCE(l.digest, h.digest, ''),
    sha256(CASE WHEN (CASE WHEN c.step < c.height THEN c.idx ELSE c.place END) % 2 = 1 THEN COALESCE(l.digest, h.digest, '') || c.folded
      ELSE c.folded || COALESCE(l.digest, h.digest, '') END)
  FROM climb c
  LEFT JOIN low l ON c.step < c.height AND l.lang IS NOT DISTINCT FROM c.lang AND l.level = c.step AND l.idx = xor(c.idx, 1)
  LEFT JOIN high h ON c.step >= c.height AND h.level = c.step - c.height AND h.idx = xor(c.place, 1)
  WHERE c.step < c.height + (SELECT MAX(level) FROM high))
SELECT c.doc_id, c.leaf, c.subroot, r.digest AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = r.digest AS verified
FROM climb c, (SELECT digest FROM high WHERE members = 1) r WHERE c.step = c.height + (SELECT MAX(level) FROM high)""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Merkle manifest of all documents, and every leaf proved against its root, a seventh of them after tampering."""
    from .merkle import manifest
    hit = F.pmod(F.crc32(F.col("_id").cast("string")), F.lit(7)) == 0
    return manifest(table(spark, sf_dir, "documents"), tampered=F.coalesce(hit, F.lit(False)))


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors whitened on their first 8 components."""
    from .whitening import whiten
    return whiten(table(spark, sf_dir, "embeddings"))


@query("op13_fingerprints")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, and its likeness to an edited text's and the next document's."""
    from .fingerprints import edited_fingerprints
    return edited_fingerprints(table(spark, sf_dir, "documents"))
