"""Registered queries of the training-data operators: thin, over whole tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, decontam, packing, quality_llr, runs, secrets, sharding, simhash, token_planes, toxicity, url_rules, vector_graph,
               whitening)
from .common import WORD_BREAK, table

#: The rules of op4's contract.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item found in it."""
    return decontam.contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(spark, table(spark, sf_dir, "documents"))


def op3_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_planes.read_planes(token_planes.write_planes(spark, table(spark, sf_dir, "documents")))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return url_rules.judge(spark, table(spark, sf_dir, "pages"), rules)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(spark.sql(
        "VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]')"))
    back = chat.read_back(chat.render(chat.fold(chat.message_log(rows))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_llr.judge(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")) \
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))

    def listed(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                         s["end"].cast("string"))))

    def number(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("found", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select("doc_id", number("assign").alias("n_assign"), number("access").alias("n_access"),
                        number("hex").alias("n_hex"), F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("found")).alias("spans"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark, table(spark, sf_dir, "embeddings"))


def op12_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.near_duplicates(spark, table(spark, sf_dir, "embeddings"))


def with_periods(docs: DataFrame) -> DataFrame:
    """The contract's rewritten texts: where crc32(doc_id) ends in 0, the words from a place on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", WORD_BREAK), lambda w: w != "")
    n = F.size(words)
    a = F.pmod(g, n).cast("int")
    tail = n - a
    p = (F.floor(tail / (F.pmod(g, F.lit(8)) + 3)) + 1).cast("int")
    root = F.slice(words, a + 1, p)
    again = F.slice(F.flatten(F.array_repeat(root, F.ceil(tail / p).cast("int"))), F.lit(1), tail)
    chosen = (F.pmod(h, F.lit(10)) == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return docs.select("doc_id", F.when(chosen, F.array_join(F.concat(F.slice(words, F.lit(1), a), again), " "))
                       .otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_periods(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"),
                                                                 (-r["period"]).alias("short"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                                             r["period"].cast("string")), F.lit("\n"))), "")
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.back")).alias("start"),
        F.col("longest.length").alias("length"), (-F.col("longest.short")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.short")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_sharding": op2_sharding,
    "op3_token_planes": op3_token_planes,
    "op4_url_rules": op4_url_rules,
    "op5_toxicity": op5_toxicity,
    "op6_packing": op6_packing,
    "op7_simhash": op7_simhash,
    "op8_chat": op8_chat,
    "op9_quality": op9_quality,
    "op10_secrets": op10_secrets,
    "op11_whitening": op11_whitening,
    "op12_vector_graph": op12_vector_graph,
    "op13_periodic_runs": op13_periodic_runs,
}

#: DuckDB SQL where it can say the same. op4: of the rules that fit, the longest; op8: the turns in order, with the
#: template's length and escapes; op12: all pairs, and the least vec_id reachable.
SQL: dict[str, str] = {
    "op12_vector_graph": r"""
        WITH RECURSIVE vectors AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_max(list_transform(embedding, lambda x: abs(x))) > 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
            ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
        reach(vec_id, other) AS (
            SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other),
        least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
        degree AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
        SELECT e.vec_id, coalesce(d.n_links, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept,
               CAST(1 AS DOUBLE) AS audit_recall
        FROM embeddings e JOIN least l USING (vec_id) LEFT JOIN degree d USING (vec_id)""",
    "op8_chat": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
        escaped AS (
            SELECT *, regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS erole,
                   regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS etext
            FROM turns),
        joined AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, erole, etext) AS said,
                   coalesce(string_agg(text, '' ORDER BY turn, erole, etext) FILTER (role = 'assistant'), '') AS loss,
                   sum(length(erole) + length(etext) + 20) AS formatted_chars
            FROM escaped GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
               CAST(formatted_chars AS BIGINT) AS formatted_chars
        FROM joined""",
    "op4_url_rules": r"""
        WITH parts AS (
            SELECT page_id,
                   translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
            FROM pages),
        rules(rule, rhost, rpath, verdict) AS (VALUES
            ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
            ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
        judged AS (
            SELECT p.page_id, p.host, p.path,
                   (SELECT max_by(r.rule, length(r.rule)) FROM rules r
                    WHERE (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath)) AS rule
            FROM parts p)
        SELECT j.page_id, j.host, j.path, j.rule, coalesce(r.verdict, 'allow') AS verdict
        FROM judged j LEFT JOIN rules r ON j.rule = r.rule""",
}
