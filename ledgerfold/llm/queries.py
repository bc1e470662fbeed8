"""One query per operator over its whole table, with the columns that its users compare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.llm.registry import query, table


@query("op9_bpe_encoding")
def bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document."""
    import public_tokenizers

    from ledgerfold.llm import bpe

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op6_sharding")
def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard under the ``key`` law: 40 shards in two regions of four racks."""
    from ledgerfold.llm.sharding import ShardTree, assign, measure, numbered

    docs = measure(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    tree = ShardTree.even(2, 4, 5)
    out = assign(assign(docs, tree), tree.grown(), shard="grown_shard")
    out = numbered(out, ties=("text_crc32", "size"))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


#: Words in hashed order per source, read up to three times, cut at the target.
MIXED = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS o
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
      FROM d GROUP BY source),
w AS (SELECT *, [1, 2, 3][place % 3 + 1] AS weight, 3 * source_size AS cap FROM s),
p AS (SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, place
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
             sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights_left
      FROM w),
q AS (SELECT *, cap::HUGEINT * weights_left <= weight::HUGEINT * remaining AS stops FROM p),
t AS (SELECT source, source_size, CASE WHEN stops THEN cap::DOUBLE ELSE weight
             * (max(remaining) FILTER (NOT stops) OVER ())::DOUBLE / max(weights_left) FILTER (NOT stops) OVER () END AS target
      FROM q),
b AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
             least(floor(t.target + 0.5)::BIGINT, 3 * t.source_size) AS budget,
             (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS pos
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
u AS (SELECT source, budget, sum(budget) OVER (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING) AS ends, sum(budget) OVER () AS total
      FROM (SELECT DISTINCT source, budget FROM b)),
g AS (SELECT source, (ends - budget) / total AS low, ends / total AS high FROM u WHERE total > 0),
k AS (SELECT i AS slot, (((i + 1)::DECIMAL(19, 0) * 0.61803398874989485::DECIMAL(17, 17)) % 1)::DOUBLE AS point
      FROM (SELECT unnest(range(0, (SELECT (max(total)::BIGINT + 1023) // 1024 FROM u))) AS i)),
x AS (SELECT source, slot, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS block FROM k JOIN g ON point >= low AND point < high),
y AS (SELECT doc_id, source, size, pos, unnest(range(low // 1024, (high - 1) // 1024 + 1)) AS block
      FROM (SELECT *, pos + turn * source_size AS low, least(pos + turn * source_size + size, budget) AS high
            FROM b CROSS JOIN (SELECT unnest([0, 1, 2]) AS turn)) WHERE low < high),
z AS (SELECT y.source, pos, min(slot) AS first_slot, count(DISTINCT slot) AS n_slots
      FROM y LEFT JOIN x ON x.source IS NOT DISTINCT FROM y.source AND x.block = y.block GROUP BY y.source, pos)
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN first_slot END::BIGINT AS first_slot,
       CASE WHEN size > 0 THEN coalesce(n_slots, 0) ELSE 0 END::BIGINT AS n_slots,
       (greatest(0, least(b.pos + size, budget) - b.pos)
        + greatest(0, least(b.pos + source_size + size, budget) - b.pos - source_size)
        + greatest(0, least(b.pos + 2 * source_size + size, budget) - b.pos - 2 * source_size))::BIGINT AS taken
FROM b LEFT JOIN z ON z.source IS NOT DISTINCT FROM b.source AND z.pos = b.pos
"""


@query("op8_mixing", MIXED)
def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, and the slots of the mix that show it."""
    from ledgerfold.llm.mixing import schedule, taken

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return taken(*schedule(docs)).select("doc_id", "size", "source_size", "target", "taken", "first_slot", "n_slots")


@query("op4_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a third of the rows is never learned from."""
    from ledgerfold.llm import langid

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = langid.held_out(F.col("doc_id"))
    net = langid.fit(docs.filter(~held))
    out = langid.predict(docs.select("doc_id", "text", held.alias("held_out")), net)
    return out.select("doc_id", "held_out", "lang_pred", "score")


@query("op3_pii")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    from ledgerfold.llm import pii

    docs = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("pii", lambda s: s["kind"] < 4)

    def count(kind: int) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(i).alias(f"n_{k.name}") for i, k in enumerate(pii.KINDS)]
    return docs.select(
        "doc_id", *counts[:4], F.sha2(pii.spelled(base), 256).alias("base_sha256"), pii.spelled(F.col("pii")).alias("spans"),
        *counts[4:], F.array_max(F.transform("pii", lambda s: s["score"])).alias("top_score"),
    )


@query("op7_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of encoded lengths with what every context limit keeps."""
    import public_tokenizers

    from ledgerfold.llm import tokens

    docs = table(spark, sf_dir, "documents").select("text")
    lengths = tokens.encoded_length(docs, public_tokenizers.path("byte_bpe_50k.json")).select("n_tokens")
    return tokens.length_histogram(lengths)


#: Rows whose id this divides are the queries of both searches.
EVERY = 20

NEAREST_CODES = """
WITH c AS (
  SELECT vec_id, list_transform(range(0, greatest(1, (max(len(embedding)) OVER () + 63) // 64)), lambda w: list_reduce(list_prepend(0::UBIGINT,
           list_transform(range(64 * w + 1, 64 * w + 65), lambda i: CASE WHEN embedding[i] > 0 THEN (1::UBIGINT << ((i - 1) % 64)) ELSE 0::UBIGINT END)),
           lambda a, b: a | b)) AS code
  FROM embeddings WHERE embedding IS NOT NULL),
d AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(range(1, 1 + len(q.code)), lambda i: bit_count(xor(q.code[i], c.code[i]))))::BIGINT AS distance
  FROM c q JOIN c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INTEGER AS rank FROM d)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 20
"""


@query("op2_topk_hamming", NEAREST_CODES)
def topk_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest sign codes of every 20th vector, against all vectors."""
    from ledgerfold.llm import hamming

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", hamming.sign_code(F.col("embedding")).alias("code"))
    found = hamming.nearest_codes(vectors, F.col("vec_id") % EVERY == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


@query("op10_learned_partitions")
def learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 vectors of largest inner product found for every 20th vector."""
    from ledgerfold.llm import ann

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = ann.nearest_vectors(vectors, F.col("vec_id") % EVERY == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


#: All pairs that share a shingle, then everything that links lead to.
LINKED = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS l
  FROM documents),
i AS (SELECT doc_id, l, unnest(range(1, greatest(len(l) - 3, 1) + 1)) AS i FROM w WHERE len(l) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(l[i:i + 3], ' ') AS g FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n f ON f.doc_id = x JOIN n h ON h.doc_id = y WHERE 100 * c >= 85 * (f.n + h.n - c)),
b AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(doc_id, c) AS (SELECT DISTINCT doc_id, doc_id FROM documents UNION SELECT b.y, r.c FROM r JOIN b ON b.x = r.doc_id WHERE r.c < b.y),
m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT CAST(d.doc_id AS BIGINT) AS doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, CAST(m.c AS BIGINT) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN m USING (doc_id)
"""


@query("op1_ngram_join", LINKED)
def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose word 4-grams are similar."""
    from ledgerfold.llm import ngram_join as join

    found = join.link_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")


@query("op5_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from ledgerfold.llm.site_tree import main_text

    pages = main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


#: CRC-32 of the decimals of an integer, bit by bit; polynomial 0xEDB88320.
CRC = """xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, 1 + len({0}::VARCHAR)),
  lambda i: ascii(({0}::VARCHAR)[i])::UBIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
  lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)))"""


def _said(*fields: str) -> str:
    one = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0} END"
    return "sha256(" + " || ".join(one.format(f) for f in fields) + ")"


#: Trees by recursion over levels, flanks by windows over runs of sixteen, folding by recursion along the flanks.
MANIFEST = f"""
WITH RECURSIVE d AS (
  SELECT *, CASE WHEN {CRC.format("doc_id")} % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                 ELSE text END AS seen FROM documents),
h AS (SELECT doc_id, source, {_said("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
             {_said("doc_id", "source", "lang", "n_chars", "seen")} AS now FROM d),
r AS (SELECT *, row_number() OVER (ORDER BY source, doc_id, leaf) AS id, count(*) OVER (PARTITION BY source) AS n,
             row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, now) - 1 AS pos FROM h),
t(level, source, pos, digest, n) AS (
  SELECT 0, source, pos, leaf, n FROM r
  UNION ALL SELECT level + 1, source, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (n + 15) // 16
  FROM t WHERE n > 1 GROUP BY level, source, pos // 16, n),
s AS (SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
v(level, pos, digest, n) AS (
  SELECT 0, pos, subroot, n FROM s
  UNION ALL SELECT level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (n + 15) // 16
  FROM v WHERE n > 1 GROUP BY level, pos // 16, n),
a AS (SELECT level, source, pos, coalesce(string_agg(digest, '') OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
             coalesce(string_agg(digest, '') OVER (b ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS g
      FROM t WHERE n > 1 WINDOW b AS (PARTITION BY level, source, pos // 16 ORDER BY pos)),
c AS (SELECT level, pos, coalesce(string_agg(digest, '') OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
             coalesce(string_agg(digest, '') OVER (b ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS g
      FROM v WHERE n > 1 WINDOW b AS (PARTITION BY level, pos // 16 ORDER BY pos)),
x AS (SELECT r.id, a.level AS step, a.l, a.g FROM r JOIN a ON a.source IS NOT DISTINCT FROM r.source AND a.pos = r.pos >> (4 * a.level)
      UNION ALL SELECT r.id, 100 + c.level, c.l, c.g
      FROM r JOIN s ON s.source IS NOT DISTINCT FROM r.source JOIN c ON c.pos = s.pos >> (4 * c.level)),
y AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY step) AS k FROM x),
e AS (SELECT r.id, sha256(coalesce(string_agg(y.l || y.g, '' ORDER BY y.step), '')) AS proof, count(y.k) AS m FROM r LEFT JOIN y USING (id) GROUP BY r.id),
z(id, k, cur) AS (
  SELECT id, 0::BIGINT, now FROM r
  UNION ALL SELECT z.id, z.k + 1, sha256(y.l || z.cur || y.g) FROM z JOIN y ON y.id = z.id AND y.k = z.k + 1)
SELECT r.doc_id, r.leaf, s.subroot, v.digest AS root, e.proof AS proof_sha256, z.cur AS folded_root, z.cur = v.digest AS verified
FROM r JOIN s ON s.source IS NOT DISTINCT FROM r.source JOIN v ON v.n = 1 JOIN e USING (id) JOIN z ON z.id = r.id AND z.k = e.m
"""


@query("op11_merkle_manifest", MANIFEST)
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document; a fifth of them is checked with changed text."""
    from ledgerfold.llm import merkle

    docs = table(spark, sf_dir, "documents")
    stored = merkle.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    touched = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    now = F.when(touched, merkle.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], lower))
    leaves = docs.select("doc_id", "source", stored.alias("leaf"), now.alias("now"))
    found = merkle.proofs(merkle.build(leaves, now="now"))
    return found.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


HARD = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, list_inner_product(a.v, b.v)::BIGINT AS score
      FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM s WHERE alike),
t AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
      FROM p JOIN s ON p.n <= 5 AND s.anchor_id = p.anchor_id AND NOT s.alike
        AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM t WHERE rank <= 5
"""


@query("op12_hard_negatives", HARD)
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five hardest negatives of every positive of every 100th vector, against all vectors."""
    from ledgerfold.llm import negatives

    vec_id = F.col("vec_id")
    label = F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return negatives.hard_negatives(rows, vec_id % 100 == 0)


@query("op13_lm_scoring")
def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a trigram model of six sevenths of the corpus."""
    from ledgerfold.llm import ngram_lm

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) != 2
    return ngram_lm.text_scores(docs, learn)
