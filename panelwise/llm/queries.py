"""One query per corpus operator over the provided tables, and SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.llm import alignment, bpe, conversation, decontam, html_text, language, line_dedup, minhash, quality, simhash, substring, url_filter, warc
from panelwise.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


URL_RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
]


#: The given pages hold no redirects or canonical links; those are tested on small tables.
_OP3_SQL = r"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages
), rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
best AS (
  SELECT page_id, arg_max({'rule': h || p, 'v': v}, length(h || p)) AS b
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id
)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.v, 'allow') AS verdict FROM parts LEFT JOIN best USING (page_id)
"""


@query("op3_url_filter", _OP3_SQL)
def op3(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    rows = url_filter.filter_urls(pages, url_filter.rules_frame(spark, URL_RULES))
    return rows.select("page_id", "host", "path", "rule", "verdict")


_OP9_SQL = """
WITH d AS (SELECT page_id, coalesce(url, '') AS url, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT h, max(page_id) AS newest FROM d GROUP BY h)
SELECT page_id, n::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (1 + ((('0x' || substr(h, (5 * (j // 4) + 1)::INTEGER, 5))::INTEGER >> (15 - 5 * (j % 4))::INTEGER) & 31))::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> newest THEN newest END AS refers_to, url
FROM d JOIN m USING (h)
"""


@query("op9_warc", _OP9_SQL)
def op9(spark, sf_dir):
    folder = warc.new_folder(spark)
    archives = warc.write_warc(table(spark, sf_dir, "pages"), folder)
    rows = warc.read_warc(archives, folder, payload=False)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


@query("op10_html_text")
def op10(spark, sf_dir):
    rows = html_text.extract_main_text(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@query("op2_byte_bpe")
def op2(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizers.path(VOCABULARY), tokenizers.PATTERN)


_OP6_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
spots AS (
  SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)
), firsts AS (SELECT win, min({'d': doc_id, 'i': i}) AS p FROM spots GROUP BY win),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS k FROM spots JOIN firsts USING (win) WHERE p.d <> doc_id OR p.i <> i
), each AS (SELECT doc_id, generate_subscripts(w, 1) AS k, unnest(w) AS word FROM words),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS text FROM each ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


@query("op6_substring_dedup", _OP6_SQL)
def op6(spark, sf_dir):
    rows = substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_minhash")
def op7(spark, sf_dir):
    return minhash.compare_with_edit(table(spark, sf_dir, "documents"))


@query("minhash_near_search")
def near_search(spark, sf_dir):
    """Texts with an id divisible by 20 against all texts: matches of the bands, verified."""
    return minhash.near_search(table(spark, sf_dir, "documents"), "key % 20 = 0")


@query("op8_quality_classifier")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = quality.score(docs.select("doc_id", "text"), quality.fit(docs))
    return rows.select("doc_id", "quality", "keep", "alarms", "weak_label")


_OP4_SQL = r"""
WITH words AS (
  SELECT 0 AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 1, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), windows AS (
  SELECT DISTINCT id AS item_id, n, w[i : i + n - 1] AS win
  FROM (SELECT id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM words WHERE kind = 1 AND len(w) > 0)
), spots AS (
  SELECT id AS doc_id, n, i, w[i : i + n - 1] AS win
  FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, (SELECT DISTINCT n FROM windows) WHERE kind = 0 AND len(w) >= n)
), hits AS (SELECT doc_id, i, n, item_id FROM spots JOIN windows USING (n, win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id)
SELECT id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered ON covered.doc_id = id LEFT JOIN items ON items.doc_id = id WHERE kind = 0
"""


@query("op4_decontamination", _OP4_SQL)
def op4(spark, sf_dir):
    rows = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op5_simhash")
def op5(spark, sf_dir):
    return simhash.groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


_OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), firsts AS (
  SELECT line, p.doc_id AS doc_id, p.i AS i, length(line) AS n
  FROM (SELECT line, min({'doc_id': doc_id, 'i': i}) AS p FROM lines WHERE trim(line) <> '' GROUP BY line)
), halves AS (
  SELECT *, unnest([{'m': n, 's': 0, 'h': left(line, n // 2)}, {'m': n, 's': 1, 'h': right(line, n // 2)},
                    {'m': n - 1, 's': 0, 'h': left(line, (n - 1) // 2)}, {'m': n - 1, 's': 1, 'h': right(line, (n - 1) // 2)}]) AS k
  FROM firsts WHERE n >= 20
), pairs AS (
  SELECT DISTINCT a.line AS line, b.line AS other FROM halves a JOIN halves b ON a.k = b.k
  WHERE a.line <> b.line AND abs(a.n - b.n) <= 1 AND (b.doc_id < a.doc_id OR (b.doc_id = a.doc_id AND b.i < a.i))
), letters AS (
  SELECT line, other, string_split(line, '') AS x, string_split(other, '') AS y FROM pairs
), heads AS (
  SELECT *, list_position(list_transform(range(1, least(len(x), len(y)) + 2), lambda k: x[k] IS DISTINCT FROM y[k]), true) AS p FROM letters
), near AS (
  SELECT DISTINCT line FROM heads
  WHERE (len(x) = len(y) AND x[p + 1 :] = y[p + 1 :]) OR (len(x) = len(y) + 1 AND x[p + 1 :] = y[p :]) OR (len(x) + 1 = len(y) AND x[p :] = y[p + 1 :])
)
SELECT l.doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE NOT stays)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE stays), '')) AS kept_sha256
FROM (
  SELECT l.*, trim(l.line) = '' OR (f.line IS NOT NULL AND near.line IS NULL) AS stays
  FROM lines l LEFT JOIN firsts f ON f.line = l.line AND f.doc_id = l.doc_id AND f.i = l.i LEFT JOIN near ON near.line = l.line
) l GROUP BY l.doc_id
"""


@query("op1_line_dedup", _OP1_SQL)
def op1(spark, sf_dir):
    rows = line_dedup.remove_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_tokenizer_alignment")
def op11(spark, sf_dir):
    paths = tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model"), tokenizers.PATTERN
    return alignment.link_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), *paths)


@query("op12_conversation_repair")
def op12(spark, sf_dir):
    damaged = conversation.damage(table(spark, sf_dir, "conversations"))
    return conversation.repair(damaged, dropped="dropped")


@query("op13_language_id")
def op13(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out(F.col("doc_id")))
    model = language.fit(docs.filter(~F.col("held_out")))
    return language.predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")
