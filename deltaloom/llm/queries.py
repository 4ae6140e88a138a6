"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import op1_quality, op2_jaccard, op3_mixing, op4_substrings, op5_packing, op6_neighbours, op7_pii, op8_backoff, op9_exact, op10_licenses, op11_merkle, op12_conversations, op13_lines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_scores(spark, sf_dir):
    return op1_quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_jaccard_join(spark, sf_dir):
    return op2_jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op3_mixing_words(spark, sf_dir):
    return op3_mixing.mixed_words(table(spark, sf_dir, "documents"))


def op4_suffix_array_dedup(spark, sf_dir):
    return op4_substrings.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op5_packing_pieces(spark, sf_dir):
    return op5_packing.packed_pieces(table(spark, sf_dir, "documents"))


def op6_nearest_neighbours(spark, sf_dir):
    return op6_neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op7_personal_data(spark, sf_dir):
    return op7_pii.personal_data(table(spark, sf_dir, "documents"))


def op8_backoff_scores(spark, sf_dir):
    return op8_backoff.backoff_scores(table(spark, sf_dir, "documents"))


def op9_exact_top_k(spark, sf_dir):
    return op9_exact.exact_top_k(table(spark, sf_dir, "embeddings"))


def op10_license_notices(spark, sf_dir):
    return op10_licenses.license_notices(table(spark, sf_dir, "documents")).drop("notices")


def op11_merkle_manifest(spark, sf_dir):
    return op11_merkle.verified_rows(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark, sf_dir):
    return op12_conversations.repaired_after_damage(table(spark, sf_dir, "conversations"))


def op13_line_dedup(spark, sf_dir):
    out = op13_lines.without_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_quality_scores, op2_jaccard_join, op3_mixing_words, op4_suffix_array_dedup, op5_packing_pieces, op6_nearest_neighbours, op7_personal_data, op8_backoff_scores, op9_exact_top_k, op10_license_notices, op11_merkle_manifest, op12_conversation_repair, op13_line_dedup)}
#: The others learn, draw, hash or join transitively, which the tests compare with brute force instead.
ORACLE_SQL: dict[str, str] = {
    "op9_exact_top_k": """
        WITH parts AS (
            SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS place FROM embeddings
        ), bad AS (
            SELECT DISTINCT vec_id FROM parts WHERE x IS NULL OR NOT isfinite(x)
        ), terms AS (
            SELECT vec_id, place, CAST(floor(1024 * x) AS BIGINT) AS v FROM parts ANTI JOIN bad USING (vec_id)
        ), found AS (
            SELECT q.vec_id AS query_id, r.vec_id, CAST(sum(q.v * r.v) AS BIGINT) AS score
            FROM terms q JOIN terms r ON q.place = r.place AND q.vec_id <> r.vec_id
            WHERE q.vec_id % 100 = 0 GROUP BY ALL
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM found
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    # crc32 bit by bit; a tree's level from the one below until one node is left
    "op11_merkle_manifest": """
        WITH RECURSIVE fields AS (
            SELECT doc_id, coalesce('=' || source, '-') AS tree, text,
                   list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                       lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)) + y)) & 1 AS last_bit,
                   coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source)::VARCHAR || ':' || source, '-')
                   || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') AS head,
                   replace(text, chr(10), '') AS bare
            FROM documents
        ), leaves AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM (
                SELECT doc_id, tree, sha256(head || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS leaf,
                       CASE WHEN last_bit = 1 THEN sha256(head || coalesce(strlen(bare)::VARCHAR || ':' || bare, '-')) END AS tampered
                FROM fields) x
        ), nodes(tree, level, i, d) AS (
            SELECT tree, 0, i, leaf FROM leaves
            UNION ALL
            SELECT tree, level + 1, i // 3, sha256(string_agg(d, '' ORDER BY i)) FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM nodes) n WHERE c > 1 GROUP BY tree, level, i // 3
        ), tops AS (
            SELECT tree, max(level) AS height, arg_max(d, level) AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM nodes GROUP BY tree
        ), upper(level, i, d) AS (
            SELECT 0, place, subroot FROM tops
            UNION ALL
            SELECT level + 1, i // 3, sha256(string_agg(d, '' ORDER BY i)) FROM (SELECT *, count(*) OVER () AS c FROM upper) n WHERE c > 1 GROUP BY level, i // 3
        ), high AS (
            SELECT max(level) AS height, arg_max(d, level) AS root FROM upper
        ), siblings AS (
            SELECT l.tree, l.i, n.level, n.i AS k, n.d FROM leaves l JOIN tops t USING (tree) JOIN nodes n ON n.tree = l.tree AND n.level < t.height
                AND n.i // 3 = l.i // CAST(3 ** (n.level + 1) AS BIGINT) AND n.i <> l.i // CAST(3 ** n.level AS BIGINT)
            UNION ALL
            SELECT l.tree, l.i, 1000 + u.level, u.i, u.d FROM leaves l JOIN tops t USING (tree) JOIN upper u ON u.level < (SELECT height FROM high)
                AND u.i // 3 = t.place // CAST(3 ** (u.level + 1) AS BIGINT) AND u.i <> t.place // CAST(3 ** u.level AS BIGINT)
        ), proofs AS (
            SELECT tree, i, sha256(string_agg(d, '' ORDER BY level, k)) AS proof FROM siblings GROUP BY tree, i
        ), low(tree, leaf_no, level, i, d) AS (
            SELECT tree, i, 0, i, coalesce(tampered, leaf) FROM leaves
            UNION ALL
            SELECT f.tree, leaf_no, f.level + 1, f.i // 3, sha256(string_agg(CASE WHEN n.i = f.i THEN f.d ELSE n.d END, '' ORDER BY n.i))
            FROM low f JOIN tops t ON t.tree = f.tree AND f.level < t.height JOIN nodes n ON n.tree = f.tree AND n.level = f.level AND n.i // 3 = f.i // 3
            GROUP BY f.tree, leaf_no, f.level, f.i
        ), further(tree, leaf_no, level, i, d) AS (
            SELECT tree, leaf_no, 0, place, d FROM low JOIN tops USING (tree) WHERE level = height
            UNION ALL
            SELECT tree, leaf_no, f.level + 1, f.i // 3, sha256(string_agg(CASE WHEN n.i = f.i THEN f.d ELSE n.d END, '' ORDER BY n.i))
            FROM further f JOIN high ON f.level < height JOIN upper n ON n.level = f.level AND n.i // 3 = f.i // 3
            GROUP BY tree, leaf_no, f.level, f.i
        )
        SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, f.d AS folded_root, f.d = root AS verified
        FROM leaves l JOIN tops USING (tree) CROSS JOIN high LEFT JOIN proofs p ON p.tree = l.tree AND p.i = l.i
        JOIN further f ON f.tree = l.tree AND f.leaf_no = l.i AND f.level = high.height
    """,
    "op13_line_dedup": """
        WITH lines AS (
            SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents) d
        ), keys AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
        ), repeated AS (
            SELECT key, max(doc_id) AS last FROM keys WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (doc_id < last) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE last IS NULL OR doc_id = last), '')) AS kept_sha256
        FROM keys LEFT JOIN repeated USING (key) GROUP BY doc_id
    """,
}
