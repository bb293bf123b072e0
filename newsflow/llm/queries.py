"""The registered queries of the corpus operators, and their DuckDB SQL where SQL can express them.

Each query applies one operator with its production parameters to a whole table and derives the digest columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm import (
    byte_bpe, chat_format, decontaminate, embedding_dedup, language_id, license_scan, mixing, periodic_runs, pii, simhash_dedup, suffix_dedup, token_alignment, token_counts,
)
from newsflow.llm.common import table


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.simhash_components(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash_dedup.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    rows = docs.select(*decontaminate.document_key(docs, "doc_id", "text"))
    found = found.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    return joined.select("doc_id", F.col("_key").isNotNull().alias("contaminated"), F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
                         F.coalesce(F.array_join(F.col("item_ids").cast("array<string>"), ","), F.lit("")).alias("item_ids"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_components(table(spark, sf_dir, "embeddings"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    labels = F.array_sort(F.array_union("base_labels", F.array_distinct(F.transform("detections", lambda d: d["label"]))))
    doubt = F.aggregate("detections", F.lit(1.0), lambda a, d: a * (1 - d["confidence"]))
    score = F.when(F.col("n_base") > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.5), 1 - doubt))).otherwise(1 - doubt)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join(labels, ",").alias("labels"), score.alias("score"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", token_counts.edit_column("doc_id", "text").alias("edits"))
    found = token_counts.apply_edits(token_counts.build_trees(docs), "edits")
    return found.select("doc_id", "n_tokens", F.size("edited_leaf_chars").cast("long").alias("n_leaves"), "edited_tokens", F.length("edited_text").cast("long").alias("edited_chars"),
                        F.sha2("edited_text", 256).alias("edited_sha256"), "encoded_chars")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs)
    found = language_id.predict(docs, model, keep=[F.col("doc_id"), (~language_id.learnable("doc_id")).alias("held_out")])
    return found.select("doc_id", "held_out", F.col("__lang_pred").alias("lang_pred"), F.col("__lang_score").alias("score"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    segments = chat_format.format_messages(rows.withColumn("parts", chat_format.text_part(F.col("text"))))
    return chat_format.digests(segments).withColumnRenamed("conv", "conv_id")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated(table(spark, sf_dir, "documents")).drop("kept_bytes")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"), [F.col("doc_id")])
    kinds = F.transform("base", lambda s: s["kind"])

    def count(k):
        return F.size(F.filter(kinds, lambda x: x == k)).cast("long").alias(f"n_{pii.KINDS[k]}")

    return found.select("doc_id", *[count(k) for k in range(pii.N_BASE)], F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"), pii.spans_text(F.col("spans")).alias("spans"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_corpus(table(spark, sf_dir, "documents"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.document_digests(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(table(spark, sf_dir, "documents"), plant=True)
    best = F.col("best")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
                        F.expr("best.length * 1000 div best.period").alias("exponent_milli"), F.sha2(periodic_runs.runs_text(F.col("runs")), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_simhash_dedup, op2_decontaminate, op3_embedding_dedup, op4_license_scan, op5_token_counts, op6_language_id, op7_chat_format, op8_mix_sources,
                                   op9_suffix_dedup, op10_pii, op11_token_alignment, op12_byte_bpe, op13_periodic_runs, pipeline)}

# a window of a benchmark item with most of its words in place, found by comparing every word with every word
_OP2 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT row_number() OVER () AS k, item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
dw AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
iw AS (SELECT k, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM i),
m AS (SELECT r, k, n, p - j AS offs, j FROM dw JOIN iw USING (word)),
c AS (SELECT r, k, n, offs FROM m GROUP BY ALL HAVING count(*) >= ceil(0.8 * least(n, 13) - 1e-9)),
s AS (SELECT DISTINCT m.r, m.k, m.n, m.offs, least(m.j, m.n - least(m.n, 13) + 1) AS a FROM m JOIN c USING (r, k, n, offs)),
f AS (SELECT DISTINCT r, k FROM (SELECT s.r, s.k, s.offs, s.a FROM s JOIN m USING (r, k, offs) WHERE m.j >= s.a AND m.j < s.a + least(s.n, 13)
      GROUP BY s.r, s.k, s.offs, s.a, s.n HAVING count(*) >= ceil(0.8 * least(s.n, 13) - 1e-9))),
g AS (SELECT f.r, list_sort(list_distinct(list(i.item_id))) AS ids FROM f JOIN i USING (k) GROUP BY f.r)
SELECT d.doc_id, g.r IS NOT NULL AS contaminated, coalesce(len(g.ids), 0)::BIGINT AS n_items, coalesce(array_to_string(g.ids, ','), '') AS item_ids FROM d LEFT JOIN g USING (r)
"""

_OP7 = """
WITH c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
e AS (SELECT *, length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) + 13 AS size FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(size)::BIGINT AS formatted_chars FROM e GROUP BY conv_id
"""

# no schedule: a source takes all its equal blocks as often as its slots go round, and the first of them once more
_OP8 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS no FROM d GROUP BY source),
s1 AS (SELECT *, CASE no % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, (source_size * 3)::DOUBLE AS most FROM s0),
s2 AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(most) OVER (ORDER BY most / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER (ORDER BY most / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lvl FROM s1),
s3 AS (SELECT *, min(CASE WHEN lvl * weight <= most THEN row_no END) OVER () AS open_at FROM (SELECT *, row_number() OVER (ORDER BY most / weight, no) AS row_no FROM s2)),
s4 AS (SELECT *, CASE WHEN open_at IS NULL OR row_no < open_at THEN most ELSE (SELECT max(x.lvl) FROM s3 x WHERE x.row_no = s3.open_at) * weight END AS target FROM s3),
s5 AS (SELECT *, greatest(ceil(source_size / 32.0)::HUGEINT, least(source_size, 64)) AS n FROM s4 WHERE source_size > 0),
s6 AS (SELECT *, source_size % n AS longer, source_size // n AS words, floor(target / source_size) AS rounds, target - floor(target / source_size) * source_size AS rest FROM s5),
s7 AS (SELECT *, CASE WHEN rest <= longer * (words + 1) THEN floor(rest / (words + 1) + 0.5) ELSE longer + floor((rest - longer * (words + 1)) / words + 0.5) END::HUGEINT AS blocks FROM s6),
s8 AS (SELECT *, blocks * words + least(blocks, longer) AS more FROM s7),
p AS (SELECT d.*, s4.no, s4.source_size, s4.target,
        coalesce(sum(d.size) OVER (PARTITION BY s4.no ORDER BY md5('42:' || d.doc_id), d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
      FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source),
w AS (SELECT r, p.size * rounds::HUGEINT + greatest(least(start + p.size, more) - start, 0) AS taken FROM p JOIN s8 USING (no))
SELECT p.doc_id, p.source, p.size, p.source_size, p.target, coalesce(w.taken, 0)::BIGINT AS taken FROM p LEFT JOIN w USING (r)
"""

ORACLE = {"op2_decontaminate": _OP2, "op7_chat_format": _OP7, "op8_mix_sources": _OP8}
