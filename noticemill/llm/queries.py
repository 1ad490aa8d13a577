"""The corpus queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, jaccard_join, jpeg, language, mixing, near_duplicates, packing, quality, tokens, top_k, toxicity, vector_codes, whitening
from .common import fold_of, table

VOCABULARY = "word_bpe_49k.json"


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn with its role after the cheapest repair and its rendering."""
    return chat.repair(table(spark, sf_dir, "conversations"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest inner products of every twentieth vector with all others."""
    return top_k.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every whole text."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary())


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicates of each document, by two-word shingles at 80 percent."""
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), width=2, similarity=0.8)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents placed into sequences of at most 4096 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


def op9_jpeg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text stored as a JPEG, read back and described."""
    return jpeg.store_texts(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text; a fifth of the ids is held out."""
    held_out = fold_of(F.col("doc_id"), 5) == 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text; a third of the ids is held out."""
    held_out = fold_of(F.col("doc_id"), 3) == 1
    scored = quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text; a quarter of the ids is held out."""
    held_out = fold_of(F.col("doc_id"), 4) == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs, language.learn_filters(docs, held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first four whitened principal components."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    each = found.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        F.col("deviation").try_cast("long").alias("deviation"),
        F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"),
        "identity_error",
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as four codes of learnt codebooks."""
    coded, codebooks = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    digits = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    return coded.select(
        "vec_id",
        F.array_join(digits, "").alias("code"),
        F.col("error").try_cast("long").alias("error"),
        F.col("label_error").try_cast("long").alias("label_error"),
        F.lit(vector_codes.digest(codebooks)).alias("codebooks_sha256"),
    )


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of each document by links of three-word shingles at 90 percent."""
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_top_k": op2_top_k,
    "op3_mixing": op3_mixing,
    "op4_token_counts": op4_token_counts,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_quality": op8_quality,
    "op9_jpeg_media": op9_jpeg_media,
    "op10_language": op10_language,
    "op11_whitening": op11_whitening,
    "op12_vector_codes": op12_vector_codes,
    "op13_jaccard_join": op13_jaccard_join,
}


def _codes_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """SQL of op12: codebooks ``c0`` to ``c4`` and the assignments ``a0`` to ``a4`` to them, a row for each component."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
            SELECT vec_id, p, CAST(min(d * 1024 + e) AS BIGINT) AS best
            FROM (SELECT x.vec_id, p, e, sum((x.v - c.v) * (x.v - c.v)) AS d FROM x JOIN c{k} c USING (p, i) GROUP BY x.vec_id, p, e)
            GROUP BY vec_id, p
        )""")
        if k < rounds:
            steps.append(f"""c{k + 1} AS MATERIALIZED (
            SELECT c.p, c.e, c.i, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.v) AS v
            FROM c{k} c LEFT JOIN (
                SELECT x.p, a.best % 1024 AS e, x.i, CAST(sum(x.v) AS BIGINT) AS s, count(*) AS n
                FROM x JOIN a{k} a USING (vec_id, p) GROUP BY 1, 2, 3
            ) m ON m.p = c.p AND m.e = c.e AND m.i = c.i
        )""")
    return f"""
        WITH e AS (
            SELECT vec_id, label, len(embedding) AS dims, generate_subscripts(embedding, 1) - 1 AS k, CAST(unnest(embedding) AS DOUBLE) AS v
            FROM embeddings WHERE embedding IS NOT NULL
        ), bad AS (
            SELECT DISTINCT vec_id FROM e WHERE v IS NULL OR isnan(v) OR isinf(v)
        ), x AS MATERIALIZED (
            SELECT vec_id, label, k // (dims // 4) AS p, k % (dims // 4) AS i, CAST(floor(1024 * v) AS BIGINT) AS v
            FROM e WHERE vec_id NOT IN (SELECT vec_id FROM bad)
        ), f AS (
            SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM (SELECT DISTINCT vec_id FROM x ORDER BY vec_id LIMIT 256)
        ), c0 AS MATERIALIZED (
            SELECT p, e, i, v FROM x JOIN f USING (vec_id)
        ), {", ".join(steps)}, r AS (
            SELECT vec_id, string_agg(printf('%02x', best % 1024), '' ORDER BY p) AS code, CAST(sum(best // 1024) AS BIGINT) AS error
            FROM a{rounds} GROUP BY vec_id
        ), t AS (SELECT r.*, x.label FROM r JOIN (SELECT DISTINCT vec_id, label FROM x) x USING (vec_id))
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, i)) FROM c{rounds}) AS codebooks_sha256
        FROM t
    """


def _components_sql(width: int, percent: int, more: str = "") -> str:
    """SQL of op5 and op13: components of documents whose shingles of ``width`` words agree to ``percent`` or more."""
    gram = " || ' ' || ".join(f"words[i + {k}]" if k else "words[i]" for k in range(width))
    return f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), s AS MATERIALIZED (
            SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {width} THEN [array_to_string(words, ' ')]
                ELSE list_transform(generate_series(1, len(words) - {width - 1}), lambda i: {gram}) END) AS grams
            FROM w
        ), g AS MATERIALIZED (
            SELECT doc_id, unnest(grams) AS gram FROM s
        ), pairs AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2
        ), links AS MATERIALIZED (
            SELECT x, y FROM pairs JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y
            WHERE 100 * common >= {percent} * (len(a.grams) + len(b.grams) - common)
        ), ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reach AS (
            SELECT x, y FROM ways UNION SELECT r.x, w.y FROM reach r JOIN ways w ON r.y = w.x
        )
        SELECT s.doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(min(reach.y), s.doc_id)) AS component_id{more}
        FROM s LEFT JOIN reach ON reach.x = s.doc_id GROUP BY s.doc_id, grams
    """


#: SQL twins of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op2_top_k": """
        WITH e AS (
            SELECT vec_id, len(embedding) AS dims, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x
            FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        ), bad AS (
            SELECT DISTINCT vec_id FROM e WHERE x IS NULL OR isnan(x) OR isinf(x)
        ), v AS (
            SELECT vec_id, dims, i, CAST(floor(64 * x) AS BIGINT) AS q FROM e WHERE vec_id NOT IN (SELECT vec_id FROM bad)
        ), s AS (
            SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(sum(a.q * b.q) AS BIGINT) AS score
            FROM v a JOIN v b ON a.i = b.i AND a.dims = b.dims AND a.vec_id <> b.vec_id
            WHERE a.vec_id % 20 = 0 GROUP BY a.vec_id, b.vec_id
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """,
    "op12_vector_codes": _codes_sql(),
    "op5_near_duplicates": _components_sql(2, 80, ", s.doc_id = component_id AS kept"),
    "op13_jaccard_join": _components_sql(3, 90),
}
