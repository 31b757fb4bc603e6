"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, collocations, decontaminate, langid, licenses, neardup, packing, secrets, substrings, tokenfiles, toolcalls, warc, whitening
from .common import ship_package


def tokenizer_path() -> str:
    """Where the public vocabulary lies; the same place on every executor."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_read(spark, sf_dir, "embeddings"), k=20, every=20)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokenfiles.count_tokens(_read(spark, sf_dir, "documents"), tokenizer_path(), keep=["doc_id"])
    part = F.regexp_extract("file", r"^part-(\d+)", 1).cast("bigint")
    piece = F.regexp_extract("file", r"-c(\d+)\.", 1).cast("bigint")
    return counts.select("doc_id", part.alias("part"), piece.alias("piece"), "document", "start", "n_tokens", "terminated")


def _held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~_held_out()))
    told = langid.identify(docs.withColumn("held_out", F.coalesce(_held_out(), F.lit(False))), model, keep=["doc_id", "held_out"])
    return told.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated_spans(_read(spark, sf_dir, "documents"), keep=["doc_id"], with_text=False, min_words=35).drop("kept_text")


def op5_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicate_classes(_read(spark, sf_dir, "documents"))


def op6_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toolcalls.link_tool_calls(_read(spark, sf_dir, "conversations"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(_read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), tokenizer_path(), keep=["doc_id"])


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_read(spark, sf_dir, "documents"), keep=["doc_id"]).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_read(spark, sf_dir, "documents"), keep=["doc_id"]).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"), components=16, scale=64)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_read(spark, sf_dir, "documents"), least=10, absorb=50, top=2000)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_nearest_neighbours, op2_token_counts, op3_language_id, op4_substring_dedup, op5_minhash_neardup, op6_tool_calls, op7_warc, op8_packing, op9_secret_scan, op10_decontamination, op11_license_scan, op12_embedding_whitening, op13_collocations)}


def oracle_sql() -> dict[str, str]:
    return {"op7_warc": OP7_SQL, "op6_tool_calls": OP6_SQL, "op11_license_scan": op11_sql(), "op13_collocations": OP13_SQL}


OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
g AS (SELECT payload_digest, min(page_id) AS first_id FROM h WHERE payload_bytes >= 100 GROUP BY 1)
SELECT h.page_id, h.payload_bytes, h.payload_digest,
  CASE WHEN g.first_id IS NULL OR g.first_id = h.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN g.first_id IS NULL OR g.first_id = h.page_id THEN NULL ELSE g.first_id END AS refers_to,
  true AS intact
FROM h LEFT JOIN g USING (payload_digest)
"""

OP6_SQL = """
WITH m AS (SELECT * FROM conversations WHERE role IS NOT NULL AND text IS NOT NULL AND turn IS NOT NULL),
c AS (SELECT conv_id, 'turn-' || turn AS call_id, turn, min(text) AS text, count(*) AS copies, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS level FROM m WHERE role = 'user' GROUP BY conv_id, turn),
r AS (SELECT conv_id, 'turn-' || (turn - 1) AS call_id, turn AS result_turn, min(text) AS content, count(*) AS results FROM m WHERE role = 'assistant' GROUP BY conv_id, turn)
SELECT conv_id, call_id, coalesce(level, 0) AS level, c.turn AS turn,
  CASE WHEN c.turn IS NOT NULL THEN 0 END AS place,
  CASE WHEN c.turn IS NOT NULL THEN 'respond' END AS tool, r.result_turn,
  CASE WHEN c.turn IS NULL THEN 'orphan' WHEN r.result_turn IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
  coalesce(copies, 0) AS copies, coalesce(results, 0) AS results,
  CASE WHEN c.turn IS NOT NULL THEN CASE WHEN c.text = '' THEN '$.prompt: too short' ELSE '' END END AS problems,
  '{"arguments":' || CASE WHEN c.turn IS NULL THEN 'null' ELSE '{"prompt":' || to_json(c.text) || '}' END
  || ',"id":' || to_json(call_id) || ',"name":' || CASE WHEN c.turn IS NULL THEN 'null' ELSE '"respond"' END
  || ',"result":' || coalesce(to_json(r.content)::VARCHAR, 'null') || '}' AS record
FROM c FULL JOIN r USING (conv_id, call_id)
"""

OP13_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
g AS (SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase FROM p, (SELECT unnest([1, 2, 3]) AS k), LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY 1, 2, 3),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY 1),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10),
s AS (SELECT c.lang, c.phrase, c.k, c.a, j, l.a AS l, r.a AS r, 1000000::HUGEINT * c.a * c.a // (l.a::HUGEINT * r.a) AS score FROM c, LATERAL (SELECT unnest(range(1, c.k)) AS j) JOIN f l ON l.lang = c.lang AND l.k = j AND l.phrase = array_to_string(list_slice(w, 1, j), ' ') JOIN f r ON r.lang = c.lang AND r.k = c.k - j AND r.phrase = array_to_string(list_slice(w, j + 1, c.k), ' ')),
b AS (SELECT lang, phrase, k, a, min_by({'l': l, 'r': r, 'score': score}, (score, j)) AS x FROM s GROUP BY 1, 2, 3, 4),
d AS (SELECT DISTINCT c.lang, u.phrase FROM c, LATERAL (SELECT unnest([array_to_string(list_slice(w, 1, 2), ' '), array_to_string(list_slice(w, 2, 3), ' ')]) AS phrase) u JOIN c two ON two.lang = c.lang AND two.k = 2 AND two.phrase = u.phrase WHERE c.k = 3 AND 100 * c.a >= 50 * two.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY x.score DESC, a DESC, b.phrase) AS rank, b.phrase, a, x.l AS l, x.r AS r, n, x.score::BIGINT AS score FROM b JOIN n USING (lang) LEFT JOIN d ON d.lang = b.lang AND d.phrase = b.phrase WHERE b.k = 3 OR d.phrase IS NULL) WHERE rank <= 2000
"""


def op11_sql(k: int = 3, drift: int = 3, whole_below: int = 20, least_share: float = 0.75) -> str:
    """The votes as joins of words; the templates stand in it as values."""
    every = [(t, label, True) for t, label in licenses.PHRASES] + [(t, label, False) for t, label in licenses.NOTICES]
    values = ", ".join(f"({i}, '{label}', {phrase}, {licenses.template_words(t)})" for i, (t, label, phrase) in enumerate(every))
    gram = "array_to_string(list_slice(w, i + 1, i + size), ' ')"
    return rf"""
WITH t(template, label, phrase, w) AS (VALUES {values}),
tg AS (SELECT template, label, phrase, length, size, i AS at_w, {gram} AS gram FROM (SELECT *, len(w) AS length, least({k}, len(w)) AS size FROM t), LATERAL (SELECT unnest(range(0, length - size + 1)) AS i)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dg AS (SELECT doc_id, size, i, {gram} AS gram FROM d, (SELECT DISTINCT size FROM tg), LATERAL (SELECT unnest(range(0, len(w) - size + 1)) AS i)),
v AS (SELECT doc_id, template, label, phrase, length, size, i - at_w AS diagonal, list(DISTINCT at_w) AS ats FROM dg JOIN tg USING (size, gram) GROUP BY ALL),
fu AS (SELECT doc_id, label, phrase, diagonal, 1e0 AS share FROM v WHERE len(ats) = length - size + 1 AND (phrase OR length < {whole_below})),
il AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS island FROM (SELECT *, coalesce((diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > {drift})::INT, 0) AS new FROM v WHERE NOT phrase AND length >= {whole_below})),
lo AS (SELECT doc_id, label, len(list_distinct(flatten(list_transform(flatten(list(ats)), lambda a: range(a, a + size))))) / length::DOUBLE AS share FROM il GROUP BY doc_id, template, label, length, size, island),
fd AS (SELECT * FROM fu UNION ALL SELECT doc_id, label, false, NULL, share FROM lo WHERE share >= {least_share}),
g AS (SELECT doc_id, count(*) FILTER (WHERE phrase) AS n_base, min(diagonal) FILTER (WHERE phrase) AS first_word, max(diagonal) FILTER (WHERE phrase) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE phrase) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM fd GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score FROM d LEFT JOIN g USING (doc_id)
"""
