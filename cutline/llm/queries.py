"""Registered queries of the operators, with production parameters over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutline.llm import (
    embedding_dedup,
    exact_dedup,
    hard_negatives,
    language_id,
    mixing,
    ngram_join,
    packing,
    passage_dedup,
    prefix_trie,
    quality,
    sharding,
    token_counts,
    token_output,
)
from cutline.llm.common import table

SHARDS = 16
ROUNDS, POWER, RATE, SEED = 8, 0.7, 0.6, 6


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1, window=2048, with_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), power=POWER, rate=RATE, rounds=ROUNDS, seed=SEED)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train(docs))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_output.write_files(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0)
    return token_output.read_files(files)


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = passage_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    return left.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), anchors=F.col("vec_id") % 100 == 0, label=label)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_token_counts, op2_sharding, op3_ngram_join, op4_exact_dedup, op5_packing, op6_mixing, op7_language_id,
              op8_token_output, op9_embedding_dedup, op10_quality, op11_prefix_trie, op12_passage_dedup,
              op13_hard_negatives)
}


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        for _ in range(8):
            i = i >> 1 ^ 0xEDB88320 * (i & 1)
        out.append(i)
    return out


def _crc_sql(b: str) -> str:
    """CRC-32 of a list of byte values."""
    return f"""xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], {b}),
               lambda c, x: xor(c >> 8, ({_crc_table()}::BIGINT[])[(xor(c, x) & 255) + 1])))"""


def _trie_sql() -> str:
    return f"""
WITH own AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT c, {_crc_sql("list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)")} % 6 AS h FROM (SELECT DISTINCT c FROM own)
), rebuilt AS (
    SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, i) AS depth, md5(length(role) || ':' || role || text) AS said, length(text) AS chars
    FROM (SELECT v.c, 0 AS own, o.i, role, text FROM convs v JOIN own o ON o.c = v.c - v.c % 100 AND o.i <= v.h
          UNION ALL SELECT c, 1, i, role, text FROM own JOIN convs USING (c) WHERE i > h)
), prefixes AS MATERIALIZED (
    SELECT c, depth, chars, md5(string_agg(said, '') OVER (PARTITION BY c ORDER BY depth)) AS k FROM rebuilt
    UNION ALL SELECT c, 0, 0, '' FROM convs
), nodes AS MATERIALIZED (
    SELECT depth, k, min(c) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM prefixes GROUP BY depth, k
), steps AS (
    SELECT n.depth, n.k, p.k AS parent FROM nodes n JOIN prefixes p ON p.c = n.conv_id AND p.depth = n.depth - 1
), children AS (
    SELECT depth - 1 AS depth, parent AS k, count(*) AS n_children FROM steps GROUP BY ALL
), weighed AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (depth, k)
), totals AS (
    SELECT p.depth, p.k, sum((w.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((w.n_convs - 1) * w.chars)::BIGINT AS saved_tokens
    FROM weighed w JOIN prefixes p ON p.c = w.conv_id AND p.depth <= w.depth GROUP BY ALL
), ends AS (
    SELECT depth, k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256
    FROM (SELECT c, max(depth) AS depth, max_by(k, depth) AS k FROM prefixes GROUP BY c) GROUP BY ALL
)
SELECT w.conv_id, w.depth, m.conv_id AS parent_conv_id, w.n_convs, w.n_children, t.n_leaves, t.saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM weighed w JOIN totals t USING (depth, k) LEFT JOIN ends e USING (depth, k)
LEFT JOIN steps s USING (depth, k) LEFT JOIN nodes m ON m.depth = w.depth - 1 AND m.k = s.parent"""


def _sharding_sql() -> str:
    mod = 1 << 64
    return f"""
WITH RECURSIVE d AS (
    SELECT doc_id, row_number() OVER () AS r, coalesce(encode(text), ''::BLOB) AS raw FROM documents
), bytes AS (
    SELECT doc_id, r, octet_length(raw) + 1 AS size,
           list_transform(range(octet_length(raw)), lambda i: ('0x' || substr(hex(raw), 2 * i + 1, 2))::BIGINT) AS b
    FROM d
), crc AS (
    SELECT doc_id, r, size, {_crc_sql("b")} AS text_crc32
    FROM bytes
), jump(doc_id, r, key, b, j) AS (
    SELECT doc_id, r, coalesce(doc_id, 0)::HUGEINT, -1::BIGINT, 0::BIGINT FROM d
    UNION ALL
    SELECT doc_id, r, next, j, floor((j + 1)::DOUBLE * (2147483648::DOUBLE / (next // 8589934592 + 1)::DOUBLE))::BIGINT
    FROM (SELECT *, (key * 2862933555777941757::HUGEINT + 1) % {mod}::HUGEINT AS next FROM jump WHERE j < {SHARDS})
), placed AS (
    SELECT doc_id, r, b::INTEGER AS shard, (CASE WHEN j = {SHARDS} THEN {SHARDS} ELSE b END)::INTEGER AS grown_shard FROM jump WHERE j >= {SHARDS}
), counted AS (
    SELECT p.*, c.size, c.text_crc32 FROM placed p JOIN crc c USING (r)
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard FROM counted"""


def _mixing_sql() -> str:
    marginals = mixing.MARGINALS
    steps, last = [], "w0"
    n = 0
    for _ in range(ROUNDS):
        for m in marginals:
            n += 1
            steps.append(f"""w{n} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.tokens,
    least(c.tokens::DOUBLE, c.weight * CASE WHEN s.sum > 0 THEN t.share * (SELECT budget FROM total) / s.sum ELSE 0 END) AS weight
    FROM {last} c JOIN (SELECT {m}, sum(weight) AS sum FROM {last} GROUP BY {m}) s USING ({m}) JOIN target_{m} t USING ({m}))""")
            last = f"w{n}"
    targets = [f"""target_{m} AS MATERIALIZED (SELECT {m}, raw / sum(raw) OVER () AS share
    FROM (SELECT {m}, pow(sum(tokens)::DOUBLE, {POWER}) AS raw FROM cells GROUP BY {m}))""" for m in marginals]
    return f"""
WITH body AS (
    SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, coalesce(text, '') AS t FROM documents
), narrow AS MATERIALIZED (
    SELECT doc_id, source, lang,
        CASE WHEN length(t) = 0 THEN 'empty'
             WHEN (length(t) - length(replace(t, '|', ''))) * 50 > length(t) THEN 'table'
             WHEN (length(t) - length(regexp_replace(t, '[0-9]', '', 'g'))) * 10 > length(t) THEN 'figures'
             WHEN length(t) >= 2000 THEN 'long prose' ELSE 'short prose' END AS topic,
        greatest(len(regexp_extract_all(t, '\\S+')), 1)::BIGINT AS tokens
    FROM body
), cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM narrow GROUP BY ALL),
total AS (SELECT sum(tokens)::DOUBLE * {RATE} AS budget FROM cells),
{", ".join(targets)},
w0 AS (SELECT *, tokens::DOUBLE * {RATE} AS weight FROM cells),
{", ".join(steps)},
chosen AS (SELECT source, lang, topic, round(weight / tokens, 9) AS probability FROM {last}),
drawn AS (
    SELECT n.*, c.probability,
        ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / {16**13}::DOUBLE AS draw
    FROM narrow n JOIN chosen c USING (source, lang, topic)
)
SELECT doc_id, source, lang, topic, tokens, probability, draw, draw < probability AS kept FROM drawn"""


ORACLES: dict[str, str] = {
    "op2_sharding": _sharding_sql(),
    "op4_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW w AS (PARTITION BY t)""",
    "op6_mixing": _mixing_sql(),
    "op11_prefix_trie": _trie_sql(),
    "op13_hard_negatives": """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS parts
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.parts::DOUBLE[], r.parts::DOUBLE[])::BIGINT AS score
    FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), positives AS MATERIALIZED (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, row_number() OVER w::INTEGER AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 5""",
}
