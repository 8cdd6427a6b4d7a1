"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelake.llm import common

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            common.ship_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        return fn
    return deco


@query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featurelake.llm import language_id

    docs = common.documents(spark, sf_dir)
    held = F.coalesce(common.remainder("doc_id", 3) == 1, F.lit(False))
    model = language_id.train(docs.filter(~held))
    return language_id.predict(docs.select("doc_id", "text", held.alias("held_out")), model)


@query("op2_ngram_join")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featurelake.llm import ngram_join

    return ngram_join.components(common.documents(spark, sf_dir))


SQL["op2_ngram_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]
                               WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x.a, x.b FROM x JOIN n na ON na.doc_id = x.a JOIN n nb ON nb.doc_id = x.b WHERE 100 * x.c >= 80 * (na.n + nb.n - x.c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) m USING (doc_id)
"""


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from featurelake.llm import packing

    return packing.pack(common.documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featurelake.llm import decontaminate

    return decontaminate.find(common.documents(spark, sf_dir), common.table(spark, sf_dir, "benchmark"))


@query("op4_line_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featurelake.llm import line_dedup

    done = line_dedup.dedup(common.documents(spark, sf_dir).select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


@query("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featurelake.llm import quality_rules

    return quality_rules.verdicts(common.documents(spark, sf_dir))


SQL["op6_quality_rules"] = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, host, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
t AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g),
r AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM t, range(8) AS o(j) WHERE c > 1 GROUP BY doc_id),
l AS (SELECT doc_id, host, pos, line FROM (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d)),
lw AS (SELECT doc_id, host, line, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) AS f, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM l),
u AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lw WHERE n > 0 GROUP BY doc_id),
c AS (SELECT host, f, count(DISTINCT doc_id) AS docs, min(doc_id) AS first_doc FROM lw WHERE n > 0 GROUP BY host, f),
h AS (SELECT host, count(DISTINCT doc_id) AS docs FROM d GROUP BY host),
q AS (SELECT c.host, c.f, c.first_doc FROM c JOIN h USING (host) WHERE c.docs > 20 AND c.docs > h.docs * 0.02::DOUBLE),
x AS (SELECT lw.doc_id, sum(lw.n) AS n FROM lw JOIN q ON q.host = lw.host AND q.f = lw.f WHERE lw.doc_id <> q.first_doc GROUP BY lw.doc_id),
b AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        coalesce(u.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(x.n, 0)::BIGINT AS n_removed_words
      FROM w LEFT JOIN r USING (doc_id) LEFT JOIN u USING (doc_id) LEFT JOIN x USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_removed_words <= 0.5::DOUBLE * n_words AS kept
FROM b
"""


@query("op7_secret_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featurelake.llm import secrets

    found = secrets.scan(common.documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "n_entropy", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


@query("op10_chat_format")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featurelake.llm import chat

    given = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.read_back(chat.windows(given.unionByName(extra)))



SQL["op10_chat_format"] = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM t),
b AS (SELECT *, (i = 1 AND role = 'system') AS sys, length(text) // 4 + len(regexp_split_to_array(text, '[\x20\x09-\x0D]+')) + 4 AS tokens,
    16 + length(replace(replace(role, chr(92), chr(92) || 's'), '<|', '<' || chr(92) || 'b'))
       + length(replace(replace(text, chr(92), chr(92) || 's'), '<|', '<' || chr(92) || 'b')) AS chars FROM o),
q AS (SELECT *, greatest(1, 2048 - 256 - max(CASE WHEN sys THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id)) AS space FROM b),
u AS (SELECT *, NOT sys AND 2 * tokens > space AS long FROM q),
p AS (SELECT *, coalesce(sum(CASE WHEN sys THEN 0 ELSE tokens END) OVER e, 0) AS before, coalesce(sum(CASE WHEN sys OR long THEN 0 ELSE tokens END) OVER e, 0) AS usual,
    coalesce(sum(long::INT) OVER e, 0) AS longs, greatest(1, space - max(CASE WHEN sys OR long THEN 0 ELSE tokens END) OVER (PARTITION BY conv_id)) AS room
  FROM u WINDOW e AS (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s AS (SELECT *, usual // room + 2 * longs + long::INT AS span FROM p),
w AS (SELECT conv_id, span, min(before) AS opens FROM s WHERE NOT sys GROUP BY ALL),
f AS (SELECT conv_id, sum(chars) AS chars FROM (
    SELECT s.conv_id, s.chars FROM s JOIN w USING (conv_id)
      WHERE s.sys OR s.span = w.span OR (w.opens > s.before AND w.opens - s.before <= 256)
    UNION ALL SELECT conv_id, chars FROM s WHERE conv_id NOT IN (SELECT conv_id FROM w)) GROUP BY conv_id),
g AS (SELECT conv_id, count(*) AS n, string_agg(role || chr(10) || text || chr(10), '' ORDER BY i) AS said,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY i), '') AS loss FROM o GROUP BY conv_id)
SELECT g.conv_id, n AS n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
  f.chars::BIGINT AS formatted_chars
FROM g JOIN f USING (conv_id)
"""


@query("op3_quality_classifier")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featurelake.llm import rule_ensemble

    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    held = F.coalesce(common.remainder("doc_id", 4) == 2, F.lit(False))
    labels = common.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).filter(~held)
    scored = rule_ensemble.score(docs.withColumn("held_out", held), rule_ensemble.fit(docs, labels))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three edits of every document, by its length: words overwritten, a stretch deleted, a line added at the end."""
    import public_tokenizers

    from featurelake.llm import token_edits

    n = F.coalesce(F.length("text"), F.lit(0))
    one = lambda start, length, said: F.struct(start.cast("int").alias("start"), F.lit(length).alias("length"), F.lit(said).alias("replacement"))
    script = F.array(one(F.floor(n / 3), 5, " [edited] "), one(F.floor(2 * n / 3), 9, ""), one(n + 10, 0, "\nThe end."))
    docs = common.documents(spark, sf_dir).select("doc_id", "text", script.alias("edits"))
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    done = token_edits.apply_edits(token_edits.with_trees(docs, ranks), ranks)
    return done.select("doc_id", "n_tokens_before", "n_tokens", "n_edits", "n_reencoded", F.length("text").cast("long").alias("n_chars"))


@query("op11_sentencepiece")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from featurelake.llm import piece_codec

    model = public_tokenizers.path("piece_bpe_32k.model")
    done = piece_codec.decode(piece_codec.encode(common.documents(spark, sf_dir).select("doc_id", "text"), model), model)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op12_importance")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featurelake.llm import importance

    drawn = importance.resample(common.documents(spark, sf_dir), common.table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


_CRC = r"""
t(i, c, k) AS (SELECT range, range, 0 FROM range(256) UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM t WHERE k < 8),
tab AS MATERIALIZED (SELECT list(c ORDER BY i) AS v FROM t WHERE k = 8)"""
SQL["op12_importance"] = rf"""
WITH RECURSIVE {_CRC},
d AS (SELECT 0 AS side, row_number() OVER () AS r, doc_id, text FROM documents UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
w AS (SELECT side, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM d),
f AS (SELECT side, r, unnest(ws) AS w FROM w),
x AS (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM f)),
y AS (SELECT w, [(instr('0123456789ABCDEF', h[i]) - 1) * 16 + instr('0123456789ABCDEF', h[i + 1]) - 1 FOR i IN range(1, len(h), 2)] AS b FROM x),
z AS (SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b::BIGINT[]),
        lambda a, e: xor(a >> 8, tab.v[(xor(a, e) & 255) + 1]))) % 10000 AS bucket FROM y, tab),
n AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM f JOIN z USING (w) GROUP BY bucket),
a AS (SELECT count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM f),
g AS (SELECT bucket, floor(1000 * ln(((n.t + 1)::DOUBLE * (a.s + 10000)::DOUBLE) / ((n.s + 1)::DOUBLE * (a.t + 10000)::DOUBLE)))::BIGINT AS g FROM n, a),
m AS (SELECT r, sum(g)::BIGINT AS total FROM f JOIN z USING (w) JOIN g USING (bucket) WHERE side = 0 GROUP BY r),
h AS (SELECT doc_id, len(ws)::BIGINT AS n, coalesce(total, 0) AS total,
        ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE AS h FROM w LEFT JOIN m USING (r) WHERE side = 0),
k AS (SELECT doc_id, n, CASE WHEN n = 0 THEN 0 ELSE (total - ((total % n) + n) % n) // n END AS weight,
        floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS noise FROM h),
o AS (SELECT *, weight + noise AS score, row_number() OVER (PARTITION BY n >= 20 ORDER BY weight + noise DESC, doc_id NULLS FIRST, weight, n) AS rank FROM k)
SELECT doc_id, n AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
  CASE WHEN n >= 20 AND rank <= (SELECT 10 * count(*) // 100 FROM k WHERE n >= 20) THEN rank END AS rank FROM o
"""


@query("op13_centroids")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featurelake.llm import centroids

    return centroids.cluster(common.table(spark, sf_dir, "embeddings"))


def _lloyd(rounds: int) -> str:
    near = """a{i} AS MATERIALIZED (SELECT r, c, d FROM (SELECT r, c, d, row_number() OVER (PARTITION BY r ORDER BY d, c) AS k FROM (
  SELECT r, c, list_sum([(v.p[j] - c{i}.p[j]) * (v.p[j] - c{i}.p[j]) FOR j IN range(1, 65)])::BIGINT AS d FROM v, c{i})) WHERE k = 1)"""
    move = """c{n} AS MATERIALIZED (SELECT c, coalesce(m.p, c{i}.p) AS p FROM c{i} LEFT JOIN (
  SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS p FROM (
    SELECT c, j, sum(p[j])::BIGINT AS s, count(*) AS n FROM a{i} JOIN v USING (r), range(1, 65) AS o(j) GROUP BY c, j) GROUP BY c) m USING (c))"""
    return ",\n".join([part.format(i=i, n=i + 1) for i in range(rounds) for part in (near, move)] + [near.format(i=rounds)])


SQL["op13_centroids"] = rf"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS p FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64),
c0 AS MATERIALIZED (SELECT (k - 1)::INT AS c, p FROM (SELECT p, row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), p) AS k FROM v) WHERE k <= 16),
{_lloyd(3)},
s AS (SELECT c, sum(d)::BIGINT AS d FROM a3 GROUP BY c)
SELECT vec_id, c AS cluster, a3.d AS distance, s.d AS cluster_inertia, (SELECT sum(d)::BIGINT FROM a3) AS inertia,
  sha256(array_to_string(c3.p, ',')) AS centroid_sha256
FROM a3 JOIN v USING (r) JOIN c3 USING (c) JOIN s USING (c)
"""
