"""Named queries over the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import ann_forest, chat_format, embed_dedup, jaccard_join, line_dedup, packing, quality, quality_rules, resampling, sentencepiece_ops, source_audit, substring_dedup, url_filter
from strata.llm.common import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: (rule, action)
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
CONTROL_CONVERSATION = ((-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"))
QUALITY_THRESHOLD = 0.3


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op1_url_filter", """
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(coalesce(raw, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') AS path FROM h),
r(rule, rule_host, rule_path, action) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
     ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
m AS (SELECT p.page_id, p.host, p.path, r.rule, r.action,
             row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule) DESC NULLS LAST, r.rule DESC) AS k
      FROM p LEFT JOIN r ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM m WHERE k = 1
""")
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "rule string, action string")
    return url_filter.url_filter(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


@query("op2_line_dedup")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n_lines = F.size(F.split("text", "\n", -1)).cast("long")
    out = line_dedup.line_dedup(docs)
    return out.select("doc_id", "lines_removed", n_lines.alias("n_lines_kept"), F.sha2("text", 256).alias("kept_sha256"))


@query("op3_embedding_dedup", """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
       AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
e AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.x) = len(q.x)
      WHERE list_cosine_similarity(p.x, q.x) >= 0.98),
r(id, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.root)
SELECT c.id AS vec_id, coalesce(n, 0) AS n_links, c.root AS component_id, c.id = c.root AS kept
FROM (SELECT id, min(root) AS root FROM r GROUP BY id) c LEFT JOIN (SELECT a, count(*) AS n FROM e GROUP BY a) d ON d.a = c.id
""")
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.embedding_classes(table(spark, sf_dir, "embeddings"))


@query("op4_ann_forest")
def op4_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_forest.nearest(table(spark, sf_dir, "embeddings"))


def held_out(doc_id):
    return F.crc32(doc_id.cast("string")) % 5 == 0


def quality_model(spark: SparkSession, sf_dir: str) -> quality.QualityModel:
    """Learnt from the labelled documents that are not held out."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    return quality.fit_quality(table(spark, sf_dir, "documents"), labels)


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.with_quality(docs, quality_model(spark, sf_dir))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


_TAIL = r"(/?s>|/?INST\]|/?SYS\]|/?ROLE\]|TEXT\])"


@query("op6_chat_format", rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, CASE WHEN role = 'assistant' THEN length('<s></s>') WHEN role = 'user' THEN length('[INST][/INST]')
                     WHEN role = 'system' THEN length('[SYS][/SYS]')
                     ELSE length('[ROLE][TEXT][/ROLE]') + length(regexp_replace(role, '([<\[])(\\*){_TAIL}', '\1\\\2\3', 'g')) END
                + length(regexp_replace(text, '([<\[])(\\*){_TAIL}', '\1\\\2\3', 'g')) AS n FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars, true AS round_trip
FROM e GROUP BY conv_id
""")
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(list(CONTROL_CONVERSATION), "conv_id long, turn long, role string, text string"))
    f = chat_format.format_chat(rows)
    # everything below is read back from what the operator wrote
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join(F.transform("loss_spans", lambda s: chat_format.unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    return f.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length(learnt).cast("long").alias("loss_chars"),
                    F.sha2(learnt, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "round_trip")


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), size=4096, end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op8_jaccard_join", r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
             FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 4 THEN ws ELSE ws[i:i + 3] END AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1)) + 1)) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT p.doc_id AS a, q.doc_id AS b FROM s p JOIN s q ON p.g = q.g AND p.doc_id <> q.doc_id JOIN n np ON np.doc_id = p.doc_id JOIN n nq ON nq.doc_id = q.doc_id
      GROUP BY p.doc_id, q.doc_id, np.n, nq.n HAVING 100 * count(*) >= 85 * (np.n + nq.n - count(*))),
r(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.root)
SELECT c.id AS doc_id, coalesce(n.n, 0) AS n_shingles, c.root AS component_id
FROM (SELECT id, min(root) AS root FROM r GROUP BY id) c LEFT JOIN n ON n.doc_id = c.id
""")
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_classes(table(spark, sf_dir, "documents"), k=4, percent=85)


@query("op9_sentencepiece")
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_file("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece_ops.with_pieces(docs, path, decoded_col="decoded")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), F.crc32(F.array_join("ids", " ")).alias("ids_crc32"), F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


@query("op10_substring_dedup", r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws[i:i + 19] AS g, i FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)),
again AS (SELECT doc_id, i FROM p QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM again),
word AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w)
SELECT w.doc_id, len(w.ws) AS n_words, coalesce(k.removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN (SELECT word.doc_id, count(gone.i) AS removed, string_agg(x, ' ' ORDER BY word.i) FILTER (gone.i IS NULL) AS kept
                  FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.i = word.i GROUP BY word.doc_id) k ON k.doc_id = w.doc_id
""")
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring_dedup.substring_dedup(docs, width=20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op11_source_audit", r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT doc_id, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, coalesce(c.n, 0) AS n FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p FROM n JOIN v USING (lang)),
q AS (SELECT lang, term, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q FROM (SELECT lang, term, sum(n) AS n FROM n GROUP BY lang, term) JOIN v USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
      GROUP BY a.lang, a.source, b.source),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM r QUALIFY part = 'pair' OR rank <= 10
""")
def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.source_divergence(table(spark, sf_dir, "documents"), min_docs=10, top=10)


#: crc32 of a feature modulo the buckets, by the bits of its bytes (DuckDB has no crc32 of its own).
_CRC = """SELECT f, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(f)), lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::BIGINT)),
       lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)), lambda v, j: xor(v >> 1, 3988292384 * (v & 1)))) AS c"""


@query("op12_resampling", rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
q AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
df AS (SELECT f, count(*) AS n FROM (SELECT unnest(ws) AS f FROM d) GROUP BY f), tf AS (SELECT f, count(*) AS n FROM (SELECT unnest(ws) AS f FROM q) GROUP BY f),
b AS (SELECT f, xor(c, 4294967295) % 10000 AS b FROM ({_CRC} FROM (SELECT f FROM df UNION SELECT f FROM tf))),
s AS (SELECT b, sum(n) AS n FROM df JOIN b USING (f) GROUP BY b), t AS (SELECT b, sum(n) AS n FROM tf JOIN b USING (f) GROUP BY b),
z AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS s_all, (SELECT coalesce(sum(n), 0) FROM t) AS t_all),
g AS (SELECT s.b, floor(1000 * ln(((coalesce(t.n, 0) + 1) * (s_all + 10000))::DOUBLE / ((s.n + 1) * (t_all + 10000))::DOUBLE))::BIGINT AS gain FROM s LEFT JOIN t ON t.b = s.b, z),
w AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM (SELECT doc_id, unnest(ws) AS f FROM d) JOIN b USING (f) JOIN g USING (b) GROUP BY doc_id),
r AS (SELECT doc_id, len(ws) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM d LEFT JOIN w USING (doc_id)),
o AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS k, count(*) OVER () AS n FROM r WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= n * 10 // 100 THEN k END AS rank FROM r LEFT JOIN o USING (doc_id)
""")
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.resample(docs, table(spark, sf_dir, "benchmark"), percent=10, min_words=20, max_n=1, buckets=10_000, seed="2024")


_STOP = ", ".join(f"'{w}', '{w.capitalize()}'" for w in quality_rules.STOP_WORDS)


@query("op13_quality_rules", rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
g AS (SELECT doc_id, i, ws[i:i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
again AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
r AS (SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS i FROM again) GROUP BY doc_id),
c AS (SELECT w.doc_id, len(ws) AS n_words, coalesce(len(array_to_string(ws, '')), 0)::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
             len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
             len(list_filter(ws, lambda x: x IN ({_STOP}))) AS n_stop_words, len(list_filter(ws, lambda x: regexp_matches(x, '[A-Za-z\x{{80}}-\x{{10FFFF}}]'))) AS n_alpha_words,
             len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*\x{{2022}}]'))) AS n_bullet_lines,
             len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|\x{{2026}})[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines
      FROM w LEFT JOIN r ON r.doc_id = w.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT *, NOT base_failed AND word_chars BETWEEN 3 * n_words AND 10 * n_words AND 100 * n_symbols <= 10 * n_words AND 100 * n_stop_words >= 2 * n_words
          AND 100 * n_alpha_words >= 70 * n_words AND 100 * n_dup_lines <= 50 * n_lines AND 100 * n_bullet_lines <= 90 * n_lines AND 100 * n_ellipsis_lines <= 30 * n_lines AS kept
FROM b
""")
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")
