"""The registered queries of this package: each applies one operator, with production
parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, decontaminate, dialogue_repair, html_extract, language_id, lexical_search, license_scan, mixing, personal_data, simhash, token_codes, url_filter, vector_search
from .common import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_codes.write_codes(table(spark, sf_dir, "documents"), tokenizer_path())
    return token_codes.read_digests(files)


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(table(spark, sf_dir, "documents"))


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_id.fit_text_model(table(spark, sf_dir, "documents"))
    return language_id.identify_pages(table(spark, sf_dir, "pages"), model)


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


@query
def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


@query
def op8_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search_every(table(spark, sf_dir, "embeddings"), 100)


ORACLE["op8_vector_search"] = """
WITH usable AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
      AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(
        list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS score
    FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank,
           vec_id, score FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.fit(pages))


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query
def op7_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = chat_format.rotate(table(spark, sf_dir, "conversations"))
    span = lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))
    return views.withColumn("spans", F.array_join(F.transform("spans", span), ","))


ORACLE["op7_chat_rotation"] = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS text,
           CAST(coalesce(floor(turn / 256), -1) AS BIGINT) AS part
    FROM conversations
), speakers AS (
    SELECT DISTINCT conv_id, role AS assistant FROM t WHERE role <> 'system'
), seg AS (
    SELECT t.conv_id, s.assistant, t.part, t.turn, t.role, t.text,
           CASE WHEN t.role = s.assistant THEN '<|assistant|>' || chr(10)
                WHEN t.role = 'system' THEN '<|system|>' || chr(10)
                ELSE '<|user:' || t.role || '|>' || chr(10) END AS head,
           t.text || '<|end|>' || chr(10) AS body
    FROM t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
), placed AS (
    SELECT *, sum(length(head) + length(body)) OVER (
               PARTITION BY conv_id, assistant, part ORDER BY turn NULLS FIRST, role, text
               ROWS UNBOUNDED PRECEDING) AS upto
    FROM seg
)
SELECT conv_id, assistant, part, CAST(0 AS BIGINT) AS piece, CAST(count(*) AS INTEGER) AS n_turns,
       string_agg(head || body, '' ORDER BY turn NULLS FIRST, role, text) AS text,
       coalesce(string_agg(CASE WHEN role = assistant THEN CAST(upto - length(body) AS BIGINT) || '-' || CAST(upto AS BIGINT) END,
                           ',' ORDER BY turn NULLS FIRST, role, text), '') AS spans
FROM placed GROUP BY conv_id, assistant, part
"""


def _seeds_sql(stride: int) -> str:
    """Texts of the words under each mask's ones, at every ``stride``-th place."""
    def under(mask: str) -> str:
        chosen = " || ' ' || ".join(["'%s'" % mask, *[f"w[p + {i + 1}]" for i, c in enumerate(mask) if c == "1"]])
        return (f"list_transform(range(0, len(w) - {len(mask) - 1}, {stride}), lambda p: {{'pos': p, 'seed': {chosen}}})")
    masks = [under(m) for m in decontaminate.MASKS]
    return f"unnest(list_concat({', '.join(masks)}))"


_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"

# Items of fewer words than a mask (none in the given tables) are left to the brute-force tests.
ORACLE["op2_decontaminate"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
ds AS (SELECT doc_id, {_seeds_sql(decontaminate.STRIDE)} AS x FROM d),
bs AS (SELECT item_id, {_seeds_sql(1)} AS x FROM b),
spots AS (SELECT DISTINCT doc_id, item_id, ds.x.pos - bs.x.pos AS shift FROM ds JOIN bs ON ds.x.seed = bs.x.seed),
beside AS (
    SELECT doc_id, item_id, shift, least(len(b.w), {decontaminate.WINDOW}) AS size, greatest(0, -shift) AS lo,
           least(len(b.w), len(d.w) - shift) AS hi,
           list_transform(range(0, len(b.w)), lambda q: CASE WHEN q + shift >= 0 AND d.w[q + shift + 1] = b.w[q + 1]
                                                             THEN 1 ELSE 0 END) AS same
    FROM spots JOIN d USING (doc_id) JOIN b USING (item_id)
), windows AS (
    SELECT doc_id, item_id, size, shift, unnest(list_transform(range(lo, hi - size + 1),
           lambda s: {{'at': s, 'matched': list_sum(list_slice(same, s + 1, s + size))}})) AS x
    FROM beside
), best AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY x.matched DESC, x.at + shift) AS place
    FROM windows WHERE x.matched >= ceil(size * {decontaminate.AGREE} - 1e-9)
)
SELECT doc_id, item_id, CAST(x.matched AS INTEGER) AS matched, CAST(size AS INTEGER) AS "window",
       CAST(x.at + shift AS INTEGER) AS start
FROM best WHERE place = 1
"""


@query
def op11_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dialogue_repair.damaged(table(spark, sf_dir, "conversations"))
    return dialogue_repair.summaries(dialogue_repair.repair(rows))


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

ORACLE["op13_lexical_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL),
live AS (SELECT r, doc_id, w, len(w) AS n FROM d WHERE len(w) > 0),
totals AS (SELECT count(*) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM live),
tf AS (SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS t FROM live) GROUP BY r, doc_id, n, t),
weights AS (
    SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(all_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM tf, totals GROUP BY t
), items AS (SELECT item_id, row_number() OVER () AS i, {_TERMS} AS w
             FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
asked AS (SELECT i, item_id, t, count(*) AS repeats FROM (SELECT i, item_id, unnest(w) AS t FROM items) GROUP BY i, item_id, t),
scored AS (
    SELECT i, item_id, r, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * all_docs) // all_terms)))) AS score
    FROM asked JOIN tf USING (t) JOIN weights USING (t), totals GROUP BY i, item_id, r, doc_id
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id,
           CAST(score AS BIGINT) AS score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@query
def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = personal_data.fit(personal_data.labelled_table(spark))
    return personal_data.digests(personal_data.find(table(spark, sf_dir, "documents"), field))
