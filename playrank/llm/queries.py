"""One query per operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playrank.llm.binary_search import search_codes, sign_code
from playrank.llm.collocations import mine_phrases, score_phrases
from playrank.llm.language_model import score_texts
from playrank.llm.line_dedup import dedup_lines
from playrank.llm.mixing import mix_plan
from playrank.llm.packing import pack_documents
from playrank.llm.personal_data import find_personal_data
from playrank.llm.pieces import encode_digests
from playrank.llm.quality_rules import judge_quality
from playrank.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401
from playrank.llm.set_join import jaccard_components
from playrank.llm.sharding import shard_records
from playrank.llm.warc import archive_pages
from playrank.llm.whitening import whiten
from playrank.session import materialize

WORDS_SQL = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def components_sql(docs: str, size: int, percent: int) -> str:
    """CTEs ending in ``component`` (doc_id, n_shingles, component_id) over the relation ``docs``."""
    run = " || ' ' || ".join(f"ws[i + {k}]" for k in range(size))
    return f"""
        word_lists AS (SELECT doc_id, coalesce({WORDS_SQL.format(text=LOWER_SQL)}, []) AS ws FROM {docs}),
        shingles AS MATERIALIZED (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= {size}
                THEN list_transform(range(1, len(ws) - {size} + 2), lambda i: {run})
                WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s
            FROM word_lists),
        set_sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS MATERIALIZED (
            SELECT x, y FROM common JOIN set_sizes p ON p.doc_id = x JOIN set_sizes q ON q.doc_id = y
            WHERE 100 * c >= {percent} * (p.n + q.n - c)),
        both_ways AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM {docs}
            UNION SELECT r.doc_id, e.y FROM reach r JOIN both_ways e ON e.x = r.other),
        smallest AS MATERIALIZED (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id),
        component AS MATERIALIZED (
            SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, m.component_id
            FROM {docs} d JOIN smallest m USING (doc_id) LEFT JOIN set_sizes z USING (doc_id))"""


@query("op3_set_join", "WITH RECURSIVE " + components_sql("documents", 3, 90) + " SELECT * FROM component")
def set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), 3, 90)


def mix_sql(docs: str) -> str:
    """CTEs ending in ``mixed`` (doc_id, size, source_size, target, rest, passes, taken) over ``docs``."""
    return f"""
        sized AS MATERIALIZED (
            SELECT doc_id, source, coalesce(len({WORDS_SQL.format(text="text")}), 0) AS size,
                   md5(concat('mix|', doc_id)) AS h FROM {docs}),
        sources AS MATERIALIZED (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
            FROM sized GROUP BY source),
        -- Sharing again ends at the level where all limits and shares add up; try the level behind each source.
        tried AS (
            SELECT (t.total - coalesce(sum(2 * o.source_size) FILTER (2 * o.source_size / o.w <= 2 * s.source_size / s.w), 0))
                   / nullif(coalesce(sum(o.w) FILTER (2 * o.source_size / o.w > 2 * s.source_size / s.w), 0), 0) AS level
            FROM sources s, sources o, (SELECT 1.5::DOUBLE * sum(source_size) AS total FROM sources) t
            GROUP BY s.source, s.source_size, s.w, t.total
            UNION ALL SELECT 1.5::DOUBLE * sum(source_size) / sum(w) FROM sources),
        levels AS (
            SELECT level FROM tried, sources GROUP BY level
            ORDER BY abs(sum(least(2 * source_size, w * level)) - (SELECT 1.5::DOUBLE * sum(source_size) FROM sources)) LIMIT 1),
        quotas AS MATERIALIZED (
            SELECT source, source_size, least(2 * source_size, w * level)::DOUBLE AS target FROM sources, levels),
        drawn AS (
            SELECT s.*, q.source_size, q.target, round(q.target)::BIGINT // nullif(q.source_size, 0) AS passes,
                   coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
            FROM sized s JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source),
        mixed AS MATERIALIZED (
            SELECT doc_id, source, h[1:2] AS block, size, source_size, target, coalesce(passes, 0) AS passes,
                   greatest(least(size, round(target)::BIGINT - coalesce(passes, 0) * source_size - before), 0)::BIGINT AS partial
            FROM drawn),
        -- Blocks with words that the sources give, again in every pass; the shards share them evenly.
        dealt AS (
            SELECT coalesce(sum(times), 0)::BIGINT AS given
            FROM (SELECT max(passes * (size > 0)::BIGINT + (partial > 0)::BIGINT) AS times FROM mixed GROUP BY source, block) x)"""


MIXING_SQL = f"""
    WITH {mix_sql("documents")}
    SELECT doc_id, size, source_size, target, passes * size + partial AS taken,
           passes * (size > 0)::BIGINT + (partial > 0)::BIGINT AS draws, given // 8 AS least_blocks, (given + 7) // 8 AS most_blocks
    FROM mixed, dealt"""


@query("op4_mixing", MIXING_SQL)
def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan's rows, with the fewest and most blocks that a shard was dealt."""
    plan = materialize(mix_plan(table(spark, sf_dir, "documents"), shards=8), "plan")
    dealt = plan.select("source", "block", F.explode("draws").alias("d")).select("source", "block", "d.pass", "d.shard").distinct()
    counts = {r["shard"]: r["count"] for r in dealt.groupBy("shard").count().collect()}  # eight rows
    blocks = [counts.get(k, 0) for k in range(8)]
    taken = F.aggregate("draws", F.lit(0).cast("bigint"), lambda total, d: total + d["words"])
    return plan.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        taken.alias("taken"),
        F.size("draws").cast("bigint").alias("draws"),
        F.lit(min(blocks)).cast("bigint").alias("least_blocks"),
        F.lit(max(blocks)).cast("bigint").alias("most_blocks"),
    )


def line_dedup_sql(docs: str, min_words: int = 50) -> str:
    """CTEs ending in ``line_kept`` (doc_id, line, kept text of a line) over ``docs`` with unique doc_id."""
    return f"""
        all_lines AS MATERIALIZED (
            SELECT doc_id, unnest(range(len(ls))) AS line, unnest(ls) AS t
            FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM {docs}) x),
        word_lines AS MATERIALIZED (
            SELECT doc_id, line, t, len({WORDS_SQL.format(text="t")}) AS words,
                   row_number() OVER (PARTITION BY doc_id ORDER BY line) AS pos,
                   sum(words) OVER (PARTITION BY doc_id ORDER BY line)::BIGINT AS upto
            FROM all_lines WHERE words > 0),
        line_windows AS MATERIALIZED (
            SELECT DISTINCT doc_id, start_pos, end_pos FROM (
                SELECT p.doc_id, p.pos AS start_pos, min(e.pos) AS end_pos
                FROM word_lines p JOIN word_lines e ON e.doc_id = p.doc_id AND e.pos >= p.pos
                    AND e.upto - p.upto + p.words >= {min_words} GROUP BY ALL
                UNION ALL
                SELECT e.doc_id, max(p.pos), e.pos
                FROM word_lines p JOIN word_lines e ON e.doc_id = p.doc_id AND e.pos >= p.pos
                    AND e.upto - p.upto + p.words >= {min_words} GROUP BY e.doc_id, e.pos) x),
        window_texts AS MATERIALIZED (
            SELECT w.doc_id, w.start_pos, w.end_pos, string_agg(l.t, chr(10) ORDER BY l.pos) AS run
            FROM line_windows w JOIN word_lines l ON l.doc_id = w.doc_id AND l.pos BETWEEN w.start_pos AND w.end_pos
            GROUP BY ALL),
        deleted AS MATERIALIZED (
            SELECT DISTINCT doc_id, unnest(range(start_pos, end_pos + 1)) AS pos FROM (
                SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, start_pos) AS nth FROM window_texts) x
            WHERE nth > 1),
        marked AS MATERIALIZED (
            SELECT a.doc_id, a.line, a.t, CASE WHEN l.pos IS NOT NULL THEN d.pos IS NOT NULL END AS gone
            FROM all_lines a LEFT JOIN word_lines l ON l.doc_id = a.doc_id AND l.line = a.line
            LEFT JOIN deleted d ON d.doc_id = l.doc_id AND d.pos = l.pos),
        line_kept AS MATERIALIZED (
            -- A blank line goes if the lines with words before and behind it do.
            SELECT doc_id, line, t, NOT coalesce(gone,
                last_value(gone IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                AND first_value(gone IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
                false) AS kept
            FROM marked)"""


LINE_DEDUP_SQL = f"""
    WITH {line_dedup_sql("documents")}
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT kept) AS n_deleted,
           coalesce(length(string_agg(t, chr(10) ORDER BY line) FILTER (kept)), 0) AS kept_chars,
           sha256(coalesce(string_agg(t, chr(10) ORDER BY line) FILTER (kept), '')) AS kept_sha256
    FROM line_kept GROUP BY doc_id"""


@query("op6_line_dedup", LINE_DEDUP_SQL)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = dedup_lines(table(spark, sf_dir, "documents"))
    gone = F.aggregate(F.coalesce("_deleted", F.array().cast("array<struct<from_line:bigint,to_line:bigint>>")), F.lit(0).cast("bigint"), lambda n, r: n + r["to_line"] - r["from_line"] + 1)
    text = F.coalesce("text", F.lit(""))
    left = F.when((F.length(text) == 0) & (gone > 0), F.lit(0)).otherwise(F.size(F.split(text, "\n", -1)))
    return deduped.select("doc_id", (left + gone).cast("bigint").alias("n_lines"), gone.alias("n_deleted"), F.length(text).cast("bigint").alias("kept_chars"), F.sha2(text, 256).alias("kept_sha256"))


@query("op2_sharding")
def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = shard_records(table(spark, sf_dir, "documents"), 8)
    return records.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op1_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rule", "kept")


def public_model() -> str:
    """Place of the public piece model on the driver; ``PIECE_MODEL`` names another."""
    if given := os.environ.get("PIECE_MODEL"):
        return given
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


@query("op5_pieces")
def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), public_model())


SEARCH_SQL = """
    WITH codes AS MATERIALIZED (
        SELECT vec_id AS id, list_reduce(list_transform(range(1, 65), lambda i: CASE WHEN embedding[i] > 0 THEN 1::HUGEINT << (i - 1) ELSE 0::HUGEINT END), lambda a, b: a | b) AS code
        FROM embeddings),
    ranked AS (
        SELECT q.id AS query_id, c.id, bit_count(xor(q.code, c.code))::BIGINT AS distance,
               row_number() OVER (PARTITION BY q.id ORDER BY bit_count(xor(q.code, c.code)), c.id) AS rank
        FROM codes q, codes c WHERE q.id % 50 = 0)
    SELECT query_id, rank, id, distance FROM ranked WHERE rank <= 10"""


@query("op8_binary_search", SEARCH_SQL)
def binary_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), sign_code("embedding").alias("code"))
    return search_codes(codes, codes.where("id % 50 = 0"), 10)


WARC_SQL = """
    WITH payloads AS MATERIALIZED (
        SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
    grouped AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM payloads)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
    FROM grouped"""


@query("op10_warc", WARC_SQL)
def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))


@query("op9_language_model")
def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


@query("op7_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def public_words() -> str:
    """Place of the public word vocabulary on the driver; ``WORD_VOCABULARY`` names another."""
    if given := os.environ.get("WORD_VOCABULARY"):
        return given
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


@query("op13_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"), public_words())
    return pieces.select(F.col("doc_id").cast("bigint").alias("doc_id"), "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op12_whitening")
def whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = whiten(table(spark, sf_dir, "embeddings"), components=32)
    explained = F.array(*[F.lit(float(x)) for x in model.explained]) if len(model.values) else F.array().cast("array<double>")
    placed = rows.select("vec_id", F.expr("try_cast(deviation AS bigint)").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    return placed.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


PHRASES_SQL = rf"""
    WITH pieces AS MATERIALIZED (
        SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
        FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER_SQL}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents) x),
    counts AS MATERIALIZED (
        SELECT lang, m AS words, phrase, count(*)::BIGINT AS f
        FROM (SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase
              FROM pieces, unnest([1, 2, 3, 4]) AS sizes(m)) x
        GROUP BY ALL),
    totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE words = 1 GROUP BY lang),
    candidates AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS ws FROM counts WHERE words > 1 AND f >= 30),
    inside AS MATERIALIZED (
        SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(f) AS longer
        FROM candidates, unnest([2, 3]) AS sizes(m), unnest([1, 2, 3]) AS places(i)
        WHERE m < words AND i + m - 1 <= words GROUP BY ALL),
    cuts AS (
        SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, ((2000000::HUGEINT * c.f) // (l.f::HUGEINT + r.f))::BIGINT AS score
        FROM candidates c LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase, unnest([1, 2, 3]) AS splits(k), counts l, counts r
        WHERE k < c.words AND l.lang = c.lang AND l.phrase = array_to_string(c.ws[:k], ' ')
          AND r.lang = c.lang AND r.phrase = array_to_string(c.ws[k + 1:], ' ')
          AND (i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * c.f)),
    worst AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM cuts),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst WHERE nth = 1)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


@query("op11_collocations", PHRASES_SQL)
def collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    mined = mine_phrases(table(spark, sf_dir, "documents"), longest=4, min_count=30, cover=80)
    return score_phrases(mined, top=2000).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
