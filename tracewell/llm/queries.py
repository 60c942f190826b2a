"""The registered queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tracewell.llm.bpe_count import count_tokens
from tracewell.llm.decontaminate import contaminated
from tracewell.llm.html_render import render_pages
from tracewell.llm.mixing import taken
from tracewell.llm.ngram_join import jaccard_components
from tracewell.llm.packing import pack
from tracewell.llm.quality_crf import fit_quality, score_quality
from tracewell.llm.quotes import conversations
from tracewell.llm.resampling import resample
from tracewell.llm.rule_lists import apply_rules, fit_rules
from tracewell.llm.token_files import token_files
from tracewell.llm.toxicity import fit_toxicity, score_toxicity
from tracewell.llm.whitening import whiten

VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return score_quality(documents, fit_quality(documents, table(spark, sf_dir, "labels")))


def op2_html_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_pages(table(spark, sf_dir, "pages"))


def op3_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations(table(spark, sf_dir, "conversations"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(table(spark, sf_dir, "documents"))


def op6_rule_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return apply_rules(documents, fit_rules(documents, table(spark, sf_dir, "labels")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return score_toxicity(documents, fit_toxicity(documents, table(spark, sf_dir, "labels")))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op11_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY), capacity=4096, end_id=1)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), components=16)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), grams=1, buckets=10_000, percent=10, least_words=20, seed="2024")


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_crf, op2_html_render, op3_quote_linking, op4_token_counts, op5_source_mixing,
        op6_rule_lists, op7_toxicity, op8_ngram_join, op9_decontaminate, op10_token_files,
        op11_best_two_fit, op12_embedding_whitening, op13_importance_resampling,
    )
}
SQL: dict[str, str] = {
    "op3_quote_linking": r"""
WITH RECURSIVE m AS MATERIALIZED (SELECT row_number() OVER () AS message, conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
l AS (SELECT message, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM (
  SELECT message, CASE WHEN regexp_matches(text, '(?m)^[ \t]*>') THEN regexp_split_to_array(text, '\r?\n') ELSE [text] END AS lines FROM m)),
v AS (SELECT *, length(regexp_replace(regexp_extract(line, '^[ \t]*((?:>[ \t]*)+)', 1), '[ \t]', '', 'g')) AS level FROM l),
r AS (SELECT *, i - row_number() OVER (PARTITION BY message, level ORDER BY i) AS island FROM v),
runs AS MATERIALIZED (SELECT message, level, min(i) AS place, string_agg(regexp_replace(line, '^[ \t]*((?:>[ \t]*)+)', ''), chr(10) ORDER BY i) AS body FROM r GROUP BY message, level, island),
own AS (SELECT message, trim(string_agg(body, chr(10) ORDER BY place), ' ' || chr(9) || chr(10)) AS body FROM runs WHERE level = 0 GROUP BY 1),
pieces AS (SELECT message, level, place, 0 AS part, body AS piece FROM runs
  UNION ALL SELECT message, level, place, 1, unnest(regexp_split_to_array(body, '\n[ \t\r]*\n')) FROM runs WHERE contains(body, chr(10))
  UNION ALL SELECT message, level, place, 2, unnest(string_split(body, chr(10))) FROM runs WHERE contains(body, chr(10))),
norms AS (SELECT DISTINCT message, level, place, part, trim(regexp_replace(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm FROM pieces),
placed AS MATERIALIZED (SELECT norms.*, conv_id, turn FROM norms JOIN m USING (message) WHERE norm <> '' AND conv_id IS NOT NULL AND turn IS NOT NULL),
here AS (SELECT norm, conv_id, min(turn) FILTER (part < 2) AS whole, min(turn) AS here FROM placed WHERE level = 0 GROUP BY 1, 2),
anywhere AS (SELECT norm, coalesce(min(struct_pack(conv := conv_id, turn := whole)) FILTER (whole IS NOT NULL), min(struct_pack(conv := conv_id, turn := here))) AS spot FROM here GROUP BY 1),
asked AS (SELECT a.message, a.level, a.place, a.part, a.conv_id, h.whole, h.here, w.spot, coalesce(h.whole < a.turn, false) AS as_whole, CASE WHEN h.whole < a.turn THEN h.whole WHEN h.here < a.turn THEN h.here END AS earlier
  FROM placed a LEFT JOIN here h ON a.norm = h.norm AND a.conv_id = h.conv_id LEFT JOIN anywhere w ON a.norm = w.norm WHERE a.level > 0),
passages AS (SELECT message, place, level, count(here) > 0 AS known, count(spot) > 0 AS linked,
  min(struct_pack(rank := 2 * part + CASE WHEN part < 2 AND NOT as_whole THEN 1 ELSE 0 END, back := -earlier)) FILTER (earlier IS NOT NULL) AS near,
  min(struct_pack(part := part, spot := spot)) FILTER (whole IS NULL AND earlier IS NULL AND spot.conv <> conv_id) AS far FROM asked GROUP BY 1, 2, 3),
found AS (SELECT message, count(*) AS n_quotes, count(*) FILTER (linked) AS n_linked, max(struct_pack(nearness := -level, turn := -near.back)) FILTER (near IS NOT NULL) AS best,
  min(far.spot) FILTER (far.part < 2 OR NOT known) AS elsewhere FROM passages GROUP BY 1),
answers AS MATERIALIZED (SELECT conv_id, turn, role, coalesce(own.body, '') AS body, coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked, best.turn AS reply_to, elsewhere.conv AS quotes_conv_id, elsewhere.turn AS quotes_turn
  FROM m LEFT JOIN own USING (message) LEFT JOIN found USING (message)),
nodes AS (SELECT conv_id, turn, max(reply_to) AS up FROM answers WHERE reply_to IS NOT NULL GROUP BY 1, 2),
paths AS (SELECT conv_id, turn, up, [CAST(up AS BIGINT)] AS path FROM nodes UNION ALL SELECT p.conv_id, p.turn, n.up, list_prepend(CAST(n.up AS BIGINT), p.path) FROM paths p JOIN nodes n ON n.conv_id = p.conv_id AND n.turn = p.up),
longest AS (SELECT conv_id, turn, arg_max(path, len(path)) AS path FROM paths GROUP BY 1, 2)
SELECT a.*, coalesce(path[1], turn)::BIGINT AS thread_turn, coalesce(len(path), 0)::BIGINT AS depth,
  dense_rank() OVER (PARTITION BY conv_id, coalesce(path[1], turn) ORDER BY list_append(coalesce(path, []::BIGINT[]), turn::BIGINT)) - 1 AS place
FROM answers a LEFT JOIN longest USING (conv_id, turn)""",
    "op8_ngram_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 2], ' ') AS s FROM w, LATERAL (SELECT unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY 1) r ON d.doc_id = r.a""",
    "op13_importance_resampling": r"""
WITH texts AS (SELECT doc_id, true AS own, text FROM documents UNION ALL SELECT NULL, false, text FROM benchmark),
w AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, own, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM texts),
each AS MATERIALIZED (SELECT k, own, word, count(*) AS n FROM (SELECT k, own, unnest(ws) AS word FROM w) GROUP BY 1, 2, 3),
crc AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, 3988292384 * (a & 1))) ORDER BY i) AS t FROM range(256) r(i)),
bytes AS (SELECT word, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS b FROM (SELECT word, hex(word) AS h FROM (SELECT DISTINCT word FROM each))),
hashed AS MATERIALIZED (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, crc),
counted AS (SELECT bucket, coalesce(sum(n) FILTER (own), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (NOT own), 0)::DOUBLE AS t FROM each JOIN hashed USING (word) GROUP BY 1),
sums AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counted),
gains AS (SELECT bucket, floor(1000 * ln(((t + 1) * (all_s + 10000)) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain FROM counted, sums),
weighed AS (SELECT k, sum(n * gain)::BIGINT AS weight FROM each JOIN hashed USING (word) JOIN gains USING (bucket) WHERE own GROUP BY 1),
scored AS (SELECT k, doc_id, len(ws) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM w LEFT JOIN weighed USING (k) WHERE own),
ranked AS (SELECT k, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN place <= 10 * able // 100 THEN place END AS rank FROM scored LEFT JOIN ranked USING (k)""",
}
