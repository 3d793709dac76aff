"""The numbered queries over one directory of tables, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewright.llm import (
    bitplanes,
    chat,
    decontaminate,
    exactdup,
    gam,
    neardup,
    packing,
    phrases,
    prefixtrie,
    sitestyle,
    toxicity,
    urlrank,
    warc,
)
from ratewright.llm.common import materialize, scratch_path, table
from ratewright.llm.tokens import PLAIN, SPACED

RULES = [
    urlrank.Rule("block", "net", "/"),
    urlrank.Rule("allow", "example.net", "/en/"),
    urlrank.Rule("block", "example.com", "/de/"),
    urlrank.Rule("allow", "org", "/fr/"),
]
MARKER = "</s>[INST] ok [/INST]"


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def importable(spark: SparkSession) -> None:
    """Let Python workers started by this session import the package where the driver does."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark_contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), n=10
    )
    hits = F.aggregate(
        F.zip_with("hit_ends", "hit_starts", lambda e, s: e - s), F.lit(0), lambda a, x: a + x
    ).cast("bigint")
    names = F.array_join(F.sort_array(F.transform("items", lambda i: i.cast("string"))), ",")
    return marked.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = materialize(
        packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), SPACED), "pieces"
    )
    return packing.pack(pieces).drop("row")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, percent=85)


def op4_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.merge_index(warc.read_archives(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitestyle.extract_main_text(table(spark, sf_dir, "pages"))


def op6_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, toxicity.train_fold(table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(MARKER).alias("text"),
    )
    formatted = materialize(chat.format_conversations(turns.unionByName(own)), "formatted")
    return chat.conversation_digests(formatted)


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrank.judge_urls(table(spark, sf_dir, "pages"), RULES)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_files")
    bitplanes.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer("word_bpe_49k.json"), PLAIN)
    return bitplanes.read_token_files(spark, path)


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = gam.train(docs, gam.train_fold(table(spark, sf_dir, "labels")))
    return gam.score(docs, model).select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), least=100, first=2000)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_QUERIES = [
    op1_decontaminate,
    op2_pack,
    op3_near_duplicates,
    op4_archive,
    op5_main_text,
    op6_exact_duplicates,
    op7_toxicity,
    op8_chat,
    op9_urls,
    op10_token_files,
    op11_quality,
    op12_prefix_trie,
    op13_collocations,
    pipeline,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def ready(query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return query(spark, sf_dir)

        return run

    return {query.__name__: ready(query) for query in _QUERIES}


_SHARED_PAYLOADS = r"""
WITH p AS (
    SELECT page_id, COALESCE(html, '') AS html, strlen(COALESCE(html, '')) AS payload_bytes,
           sha1(COALESCE(html, '')) AS payload_digest
    FROM pages
), r AS (
    SELECT payload_digest, MAX(page_id) AS kept FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN r.kept <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN r.kept <> p.page_id THEN r.kept END AS refers_to
FROM p LEFT JOIN r USING (payload_digest)
"""

_EQUAL_TEXTS = r"""
WITH t AS (
    SELECT doc_id, sha256(regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
), g AS (
    SELECT text_sha256, MIN(doc_id) AS keep_id, COUNT(*) AS group_size FROM t GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""

_WINDOWS = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(
        translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(
        translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), bw AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
    FROM (SELECT item_id, w, LEAST(10, len(w)) AS n, unnest(range(1, len(w) - LEAST(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), dw AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
), hits AS (
    SELECT doc_id, n, i, item_id FROM dw JOIN bw USING (n, g)
), words AS (
    SELECT doc_id, COUNT(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM hits)) GROUP BY doc_id
), items AS (
    SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
       sha256(COALESCE(names, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_NEAR = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x : x <> '') AS w
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, g FROM (
        SELECT doc_id, array_to_string(w[i:i + LEAST(3, len(w)) - 1], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - LEAST(3, len(w)) + 2)) AS i FROM d WHERE len(w) > 0))
), n AS (
    SELECT doc_id, COUNT(*) AS n_shingles FROM s GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id
    JOIN n AS na ON na.doc_id = a.doc_id JOIN n AS nb ON nb.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, na.n_shingles, nb.n_shingles
    HAVING 100 * COUNT(*) >= 85 * (na.n_shingles + nb.n_shingles - COUNT(*))
), ends AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM d
    UNION
    SELECT reach.a, ends.b FROM reach JOIN ends ON reach.b = ends.a
)
SELECT d.doc_id, COALESCE(n_shingles, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, MIN(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""

_CHAT = r"""
WITH c AS (
    SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), t AS (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k,
           length(regexp_replace(text, '(\\|<s>|</s>|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>)', '\1_', 'g'))
               + length(role) + length('<|im_start|>') + 1 + length('<|im_end|>') + 1 AS chars
    FROM c
), f AS (
    SELECT *, LAG(role) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM t
)
SELECT conv_id, COUNT(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       SUM(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS loss_chars,
       sha256(COALESCE(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY k), '')) AS loss_sha256,
       SUM(chars) AS formatted_chars,
       BOOL_AND(CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before = 'user' THEN role = 'assistant'
                     WHEN before IN ('system', 'assistant') THEN role = 'user' ELSE FALSE END) AS valid
FROM f GROUP BY conv_id
"""


_TRIE = r"""
WITH t AS (
    SELECT conv_id, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS k, digest, bytes
    FROM (SELECT conv_id, turn, strlen(COALESCE(text, '')) AS bytes,
                 md5(strlen(COALESCE(role, '')) || ':' || COALESCE(role, '') || COALESCE(text, '')) AS digest
          FROM conversations WHERE conv_id IS NOT NULL)
), c AS (
    SELECT conv_id, crc32 % 9 AS h, conv_id - conv_id % 5 AS donor
    FROM (SELECT DISTINCT conv_id, {crc32} AS crc32 FROM conversations WHERE conv_id IS NOT NULL)
), r AS (
    SELECT conv_id, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY part, k) AS d, digest, bytes
    FROM (SELECT c.conv_id, 0 AS part, k, digest, bytes FROM c JOIN t ON t.conv_id = c.donor AND k <= h
          UNION ALL SELECT c.conv_id, 1, k, digest, bytes FROM c JOIN t ON t.conv_id = c.conv_id AND k > h)
), p AS (
    SELECT conv_id, 0 AS d, '' AS prefix, 0 AS bytes FROM c
    UNION ALL
    SELECT conv_id, d, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY d), bytes FROM r
), lens AS (
    SELECT conv_id, MAX(d) AS len FROM p GROUP BY conv_id
), n AS (
    SELECT prefix, d, MIN(p.conv_id) AS conv_id, COUNT(*) AS n_convs, ANY_VALUE(bytes) AS bytes,
           sha256(COALESCE(string_agg(CASE WHEN len = d THEN CAST(p.conv_id AS VARCHAR) END, ',' ORDER BY p.conv_id), '')) AS ends_sha256
    FROM p JOIN lens USING (conv_id) GROUP BY prefix, d
), k AS (
    SELECT n.*, u.conv_id AS parent_conv_id FROM n LEFT JOIN p ON p.conv_id = n.conv_id AND p.d = n.d - 1
    LEFT JOIN n AS u ON u.prefix = p.prefix
), kids AS (
    SELECT parent_conv_id AS conv_id, d - 1 AS d, COUNT(*) AS n_children FROM k WHERE d > 0 GROUP BY ALL
), m AS (
    SELECT k.*, COALESCE(n_children, 0) AS n_children FROM k LEFT JOIN kids USING (conv_id, d)
), subtree AS (
    SELECT p.prefix, SUM(CASE WHEN m.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
           SUM((m.n_convs - 1) * m.bytes) AS saved_tokens
    FROM m JOIN p ON p.conv_id = m.conv_id AND p.d <= m.d GROUP BY p.prefix
)
SELECT conv_id, CAST(d AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM m JOIN subtree USING (prefix)
"""


_PHRASES = r"""
WITH p AS (
    SELECT COALESCE(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), w AS MATERIALIZED (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), f AS MATERIALIZED (
    SELECT lang, k, phrase, COUNT(*) AS a FROM (
        SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) AS r(k) WHERE len(w) >= k))
    GROUP BY ALL
), n AS MATERIALIZED (
    SELECT lang, SUM(a) AS n FROM f WHERE k = 1 GROUP BY lang
), c AS MATERIALIZED (
    SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 100
), halves AS MATERIALIZED (
    SELECT lang, k, phrase, a, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)
), heads AS MATERIALIZED (
    SELECT halves.*, f.a AS l FROM halves JOIN f ON f.lang = halves.lang AND f.phrase = halves.head
), tails AS MATERIALIZED (
    SELECT heads.*, f.a AS r FROM heads JOIN f ON f.lang = heads.lang AND f.phrase = heads.tail
), cuts AS MATERIALIZED (
    SELECT tails.*, n, (1000::HUGEINT * a * n) // (l::HUGEINT * r) AS score FROM tails JOIN n USING (lang)
), least AS MATERIALIZED (
    SELECT * FROM cuts QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_phrases AS (
    SELECT lang, array_to_string(w[i:j], ' ') AS phrase, MAX(a) AS around
    FROM (SELECT *, unnest(range(i + 1, k + 1)) AS j FROM (SELECT *, unnest(range(1, k)) AS i FROM c))
    WHERE j - i + 1 < k GROUP BY ALL
), kept AS (
    SELECT lang, phrase, a, l, r, n, score FROM least LEFT JOIN inner_phrases USING (lang, phrase)
    WHERE around IS NULL OR 100 * around < 100 * a
)
SELECT lang, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= 2000
"""


def _crc32_sql(text: str) -> str:
    """SQL of the CRC-32 of an ASCII text: the bitwise form over its characters."""
    byte = f"list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    shift = "(CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)"
    eight = "list_reduce(range(8), lambda v, i: " + shift + ", xor(a, b))"
    return f"xor(list_reduce({byte}, lambda a, b: {eight}, 4294967295::BIGINT), 4294967295)"


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontaminate": _WINDOWS,
        "op3_near_duplicates": _NEAR,
        "op4_archive": _SHARED_PAYLOADS,
        "op6_exact_duplicates": _EQUAL_TEXTS,
        "op8_chat": _CHAT,
        "op12_prefix_trie": _TRIE.format(crc32=_crc32_sql("CAST(conv_id AS VARCHAR)")),
        "op13_collocations": _PHRASES,
    }
