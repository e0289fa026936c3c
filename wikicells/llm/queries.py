"""One query for each operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikicells.llm import secrets
from wikicells.llm.alignment import align
from wikicells.llm.bpe import round_trip
from wikicells.llm.chat import rotate
from wikicells.llm.collocations import collocations
from wikicells.llm.minhash import near_duplicates
from wikicells.llm.mixture import by_position, mix
from wikicells.llm.nearest import nearest
from wikicells.llm.passages import without_passages
from wikicells.llm.shards import interleave
from wikicells.llm.suffixes import without_repeats
from wikicells.llm.toxicity import held_out, learn, score
from wikicells.llm.voronoi import top_products


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(read(spark, sf_dir, "documents"), threshold=200).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks as start-end pairs in text form, comma-joined."""
    masks = F.array_join(F.transform("masks", lambda m: F.concat_ws("-", m["start"], m["end"])), ",")
    return rotate(read(spark, sf_dir, "conversations")).withColumn("masks", masks)


def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_position(mix(read(spark, sf_dir, "documents"))).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "position"
    )


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.find_secrets(read(spark, sf_dir, "documents"), threshold=0.5))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = score(docs, learn(docs, read(spark, sf_dir, "labels")), threshold=0.7)
    kept_back = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    return scored.select("doc_id", kept_back.alias("held_out"), "score", "predicted", "n_plain", "n_misspelled", "n_quoted")


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), words=3, percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trip(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def block_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), k=10, every=100)


def voronoi_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(read(spark, sf_dir, "embeddings"), k=20, every=20, scale=64)


def passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_passages(read(spark, sf_dir, "documents"), window=50).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align(read(spark, sf_dir, "documents"), *paths)


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"), top=2000, least=10, share=50)


QUERIES = {
    "op1_suffix_dedup": suffix_dedup,
    "op2_chat_formatting": chat,
    "op3_secret_scan": secret_scan,
    "op4_mixture": mixture,
    "op5_sharding": sharding,
    "op6_toxicity": toxicity,
    "op7_near_dedup": near_dedup,
    "op8_block_nearest": block_nearest,
    "op9_byte_bpe": byte_bpe,
    "op10_voronoi_products": voronoi_products,
    "op11_passage_automata": passage_dedup,
    "op12_token_alignment": token_alignment,
    "op13_phrase_collocations": phrase_collocations,
}

ORACLES = {
    "op2_chat_formatting": r"""
        WITH turns AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS body, md5(concat_ws(':', coalesce(role, ''), coalesce(text, ''))) AS tie
            FROM conversations
        ), people AS (
            SELECT DISTINCT conv_id, role AS perspective FROM turns WHERE role IS NOT NULL AND role <> 'system'
        ), pieces AS (
            SELECT p.conv_id, perspective, turn, tie, role IS NOT DISTINCT FROM perspective AS own, body,
                CASE WHEN role IS NOT DISTINCT FROM perspective THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>'
                    WHEN role IS NULL THEN '<|user|>' ELSE '<|user name=' || role || '|>' END || chr(10) AS head
            FROM turns t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
        ), placed AS (
            SELECT *, sum(length(head) + length(body) + 8) OVER (
                PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, tie ROWS UNBOUNDED PRECEDING) AS until
            FROM pieces
        )
        SELECT conv_id, perspective, 0::INT AS part, string_agg(head || body || '<|end|>' || chr(10), '' ORDER BY until) AS text,
            coalesce(string_agg((until - 8 - length(body))::BIGINT || '-' || (until - 1)::BIGINT, ',' ORDER BY until) FILTER (WHERE own), '') AS masks,
            count(*) AS n_turns, count(*) FILTER (WHERE own) AS n_own
        FROM placed GROUP BY conv_id, perspective""",
    "op4_mixture": r"""
        WITH docs AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
        ), keyed AS (
            SELECT *, md5('mixture:' || coalesce(doc_id::VARCHAR, '') || ':' || size) AS key FROM docs
        ), sizes AS (
            SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
        ), numbered AS (
            SELECT *, [3, 1, 2][(number % 3 + 1)::INT] AS weight, [0.5, -0.5, 0.0][(number % 3 + 1)::INT]::DOUBLE AS slope
            FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number FROM sizes)
        ), filled AS (
            SELECT *, coalesce(sum(2 * source_size) OVER before, 0)::BIGINT AS filled,
                (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS open, (sum(source_size) OVER ())::BIGINT AS everything
            FROM numbered
            WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), levels AS (
            SELECT *, (1.5::DOUBLE * everything - filled) / open AS level FROM filled
        ), chosen AS (
            SELECT arg_min(level, {'f': filled, 'l': level}) AS level FROM levels WHERE level * weight <= 2 * source_size
        ), goals AS (
            SELECT source, source_size, slope, least(chosen.level * weight, (2 * source_size)::DOUBLE) AS target
            FROM levels CROSS JOIN chosen
        ), placed AS (
            SELECT k.doc_id, k.size, g.source_size, g.slope, g.target, floor(g.target)::BIGINT AS goal,
                (sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ROWS UNBOUNDED PRECEDING) - k.size)::BIGINT AS ahead
            FROM keyed k JOIN goals g ON k.source IS NOT DISTINCT FROM g.source
        ), taken AS (
            SELECT *, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS epochs,
                greatest(0, least(size, goal - CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END * source_size - ahead)) AS extra
            FROM placed
        )
        SELECT doc_id, size, source_size, target, (epochs * size + extra)::BIGINT AS taken,
            (CASE WHEN size > 0 THEN epochs ELSE 0 END + CASE WHEN extra > 0 THEN 1 ELSE 0 END)::INT AS copies,
            CASE WHEN epochs * size + extra > 0 THEN
                CASE WHEN slope = 0 THEN ahead / target
                    ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * (ahead / target)) - (1 - slope)) / (2 * slope) END
            END AS position
        FROM taken""",
    "op5_sharding": r"""
        WITH crc AS (
            SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
                lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step
        ), docs AS (
            SELECT doc_id, source, strlen(coalesce(text, '')) + 1 AS size, hex(coalesce(text, '')) AS hex,
                md5('interleave:' || coalesce(doc_id::VARCHAR, '')) AS key
            FROM documents
        ), summed AS (
            SELECT * EXCLUDE (hex, step), xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(range(1, len(hex), 2), lambda i: ('0x' || substr(hex, i, 2))::BIGINT)),
                lambda c, b: xor(c >> 8, step[xor(c & 255, b) + 1]))) AS text_crc32
            FROM docs CROSS JOIN crc
        ), ranked AS (
            SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY key, doc_id, text_crc32, size) - 1)
                / (2.0::DOUBLE * count(*) OVER (PARTITION BY source)) AS fraction
            FROM summed
        ), placed AS (
            SELECT *, row_number() OVER (ORDER BY fraction, source NULLS LAST) - 1 AS place, count(*) OVER () AS n FROM ranked
        ), cut AS (
            SELECT *, place * 8 // n AS shard FROM placed
        )
        SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard::INT AS shard,
            (place - (shard * n + 7) // 8)::BIGINT AS slot, NULL::DOUBLE AS grown_shard, source
        FROM cut""",
    "op7_near_dedup": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] END) AS s
            FROM words
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * shared >= 85 * (x.n + y.n - shared)
        ), reach AS (
            SELECT doc_id AS id, doc_id AS other FROM documents
            UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
        ), roots AS (
            SELECT id, min(other) AS component_id FROM reach GROUP BY id
        )
        SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM documents d JOIN roots ON id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id""",
    "op8_block_nearest": r"""
        WITH fine AS (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), scored AS (
            SELECT q.vec_id AS query_id, x.vec_id, sqrt(list_reduce(
                list_transform(range(1, len(q.v) + 1), lambda i: (x.v[i] - q.v[i]) * (x.v[i] - q.v[i])), lambda a, b: a + b)) AS score
            FROM fine q JOIN fine x ON q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id AND len(q.v) = len(x.v)
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INT AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 10""",
    "op10_voronoi_products": r"""
        WITH fine AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v)::BIGINT AS score
            FROM fine q JOIN fine x ON q.vec_id % 20 = 0 AND q.vec_id <> x.vec_id AND len(q.v) = len(x.v)
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 20""",
    "op11_passage_automata": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), starts AS (
            SELECT row, doc_id, w, unnest(range(1, len(w) - 48)) AS start FROM docs WHERE doc_id IS NOT NULL
        ), windows AS (
            SELECT row, doc_id, start, md5(array_to_string(w[start:start + 49], ' ')) AS key FROM starts
        ), firsts AS (
            SELECT key, min(doc_id) AS first FROM windows GROUP BY key
        ), gone AS (
            SELECT row, list(start) AS found FROM windows JOIN firsts USING (key) WHERE first < doc_id GROUP BY row
        ), places AS (
            SELECT DISTINCT row, unnest(flatten(list_transform(found, lambda x: range(x, x + 50)))) AS place FROM gone
        ), covered AS (
            SELECT row, list(place) AS places FROM places GROUP BY row
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed, sha256(coalesce(array_to_string(
            CASE WHEN places IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(places, i)) END, ' '), '')) AS kept_sha256
        FROM docs LEFT JOIN covered USING (row)""",
    "op13_phrase_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), runs AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
        ), grams AS (
            SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
            FROM runs CROSS JOIN (VALUES (1), (2), (3)) sizes(k)
        ), counts AS (
            SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
        ), totals AS (
            SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang
        ), candidates AS (
            SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 10
        ), cuts AS (
            SELECT c.lang, c.k, c.phrase, a, cut, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
            JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
            JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:c.k], ' ')
        ), scored AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
        ), within AS (
            SELECT lang, phrase, max(a) AS wider FROM (
                SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM candidates WHERE k = 3
                UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM candidates WHERE k = 3) GROUP BY ALL
        ), left_over AS (
            SELECT s.* FROM scored s LEFT JOIN within v ON v.lang = s.lang AND v.phrase = s.phrase AND s.k = 2
            WHERE wider IS NULL OR 100 * wider < 50 * a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM left_over JOIN totals USING (lang) QUALIFY rank <= 2000""",
}
