"""The registered queries of this package, each beside its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .chatformat import conversation_digests, format_conversations
from .common import table, utf8_length
from .decontam import contamination
from .langid import identify_languages, learn_languages
from .mixing import dominant_topic, mix
from .neardup import near_duplicates
from .repair import damage, repair_conversations
from .repeats import remove_repeats
from .sharding import shard_documents
from .tokens import count_tokens
from .topk import scaled, top_k
from .urlfilter import judge_urls
from .warc import archive_pages
from .whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return register


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify_languages(docs, learn_languages(docs, tokenizer_path("piece_bpe_32k.model")))


@query("""
WITH records AS (
    SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS f FROM records
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND page_id > f THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > f THEN f END AS refers_to
FROM firsts
""")
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))


@query()
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


#: What the kind of content is told by, and the mixture: exponents of the tokens, share of all tokens, rounds.
TOPICS = {"contact": "[A-Za-z0-9]@[A-Za-z0-9]", "legal": "[Ll]icen[cs]e", "noise": "[#$%&*!]{3}", "tabular": "[|]"}
EXPONENTS = {"source": 0.7, "lang": 0.8, "topic": 0.8}
BUDGET, ROUNDS = 0.6, 10


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of :func:`mix`, for source, language and kind of content; four bytes count as a token."""
    text = F.col("text")
    dimensions = {"source": F.col("source"), "lang": F.col("lang"), "topic": dominant_topic(text, TOPICS, "prose")}
    return mix(docs, dimensions, EXPONENTS, F.ceil(utf8_length(text) / 4), BUDGET, ROUNDS)


def _mixing_sql() -> str:
    counts = ", ".join(f"len(regexp_extract_all(coalesce(text, ''), '{p}')) AS {t}" for t, p in TOPICS.items())
    best = f"greatest({', '.join(TOPICS)})"
    topic = f"CASE WHEN {best} = 0 THEN 'prose' " + " ".join(f"WHEN {t} = {best} THEN '{t}'" for t in sorted(TOPICS)) + " END"
    key = lambda c: f"coalesce('=' || CAST({c} AS VARCHAR), '')"
    parts = [f"counts AS (SELECT *, {counts} FROM documents)",
             f"""rows AS (SELECT doc_id, CAST(ceil(octet_length(encode(coalesce(text, ''))) / 4) AS BIGINT) AS n_tokens,
                 {key('source')} AS k0, {key('lang')} AS k1, {key(topic)} AS k2 FROM counts)""",
             "cells AS (SELECT k0, k1, k2, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM rows GROUP BY ALL)"]
    for i, e in enumerate(EXPONENTS.values()):
        parts.append(f"part{i} AS (SELECT k{i}, pow(sum(tokens), {e}) AS part FROM cells GROUP BY k{i} HAVING sum(tokens) > 0)")
        parts.append(f"want{i} AS (SELECT k{i}, part / (SELECT sum(part) FROM part{i}) * ({BUDGET} * (SELECT sum(tokens) FROM cells)) AS want{i} FROM part{i})")
    parts.append(f"step0 AS (SELECT *, CAST({BUDGET} AS DOUBLE) AS rate FROM cells LEFT JOIN want0 USING (k0) LEFT JOIN want1 USING (k1) LEFT JOIN want2 USING (k2))")
    step = 0
    for _ in range(ROUNDS):
        for i in range(3):
            new = f"CASE WHEN now{i} > 0 THEN rate * want{i} / now{i} ELSE rate END"
            if i == 2:
                new = f"least({new}, 1.0)"
            parts.append(f"""step{step + 1} AS MATERIALIZED (SELECT * EXCLUDE (rate, now{i}), {new} AS rate
                FROM (SELECT *, sum(tokens * rate) OVER (PARTITION BY k{i}) AS now{i} FROM step{step}))""")
            step += 1
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, k2[2:] AS topic, n_tokens, round(rate, 6) AS rate,
       CAST('0x' || md5('mix' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:13] AS BIGINT) / 4503599627370496.0 < rate AS sampled
FROM rows JOIN step{step} USING (k0, k1, k2)"""


@query(_mixing_sql())
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    topic = dominant_topic(F.col("text"), TOPICS, "prose").alias("topic")
    return mixed(docs).select("doc_id", topic, F.col("__tokens").alias("n_tokens"), F.round("__rate", 6).alias("rate"), F.col("__sampled").alias("sampled"))


@query()
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


#: The rules of the URL query.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query("""
WITH cut AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), rules(h, p, v) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), best AS (
    SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
    FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    GROUP BY page_id, host, path
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best
""")
def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


@query()
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("""
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 5
""")
def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", scaled(F.col("embedding")).alias("vector"))
    return top_k(vectors, F.col("vec_id") % 50 == 0)


@query(r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), item_starts AS (
    SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM items WHERE len(w) > 0
), grams AS (
    SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS g FROM item_starts
), doc_starts AS (
    SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM docs, (SELECT DISTINCT k FROM grams)
), hits AS (
    SELECT doc_id, item_id, k, s FROM (SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS g FROM doc_starts) JOIN grams USING (k, g)
), hit_words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(*) AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS items_sha256
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
""")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query()
def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    found = repair_conversations(damage(turns)).summary
    every, none = turns.select(F.col("conv_id").alias("id")).distinct(), F.lit(0).cast("bigint")
    met = every.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, none).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return met.select(F.col("id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


#: The conversation that holds the template's own marks.
MARKED = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


@query(r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), placed AS (
    SELECT *, coalesce(lag(role) OVER w = role, false) AS joins FROM turns
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), sized AS (
    SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
              + (length(text) - length(replace(text, '</turn>', ''))) // 7 + (length(text) - length(replace(text, '<part>', ''))) // 6
              + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)), 0) AS chars
    FROM placed
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars + CASE WHEN joins THEN 6 ELSE length(role) + 14 END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
""")
def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame(MARKED, turns.schema)
    return conversation_digests(format_conversations(turns.union(marked)))


@query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", scaled(F.col("embedding")).alias("vector"))
    return whiten(vectors)
