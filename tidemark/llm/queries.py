"""Queries over the benchmark tables, one for each operator, each over its whole table."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard_join, kneser_ney, language_id, line_dedup, packing, periodic_runs, quality_rules, rule_ensemble, suffix_dedup, toxicity, url_filters, whitening
from tidemark.llm.common import fold, table

#: FIXED VALUES: rules of the URL query (verdict, host, path), and the site labels whose pages it lists.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
UNWANTED_SITES = ["adult-x", "spam-farm"]


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    samples = language_id.learn_samples(docs.where(fold("doc_id", 4) != 2))
    found = language_id.identify(docs.select("doc_id", "text"), samples)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), word_tokenizer())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = rule_ensemble.learn(docs, labels.where(fold("doc_id", 5) != 0))
    scored = rule_ensemble.score(docs, model)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where(F.arrays_overlap(F.split(url_filters.host_of(F.col("url")), r"\."), F.array(*map(F.lit, UNWANTED_SITES))))
    judged = url_filters.judge_urls(pages, listed, rules=URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "listed")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    voted = quality_rules.quality_votes(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return quality_rules.judge_votes(voted).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality_probability")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["begin"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels.where(fold("doc_id", 5) != 0))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = kneser_ney.train(docs.where(fold("doc_id", 7) != 2))
    scored = kneser_ney.score(docs, model)
    return scored.select(
        "doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        F.col("unigram_score").alias("base_score"), F.col("lm_score").alias("score"), "perplexity",
    )


def repeated_from(key: int | None, words: list[bytes]) -> list[bytes]:
    """In one text of ten, by its key, the words from some place on repeat with a period of a third of them or less."""
    h, n = (1 if key is None else zlib.crc32(str(key).encode())), len(words)
    if h % 10:
        return words
    begin = (h // 10) % n
    period = 1 + (n - begin) // (3 + h // 10 % 8)
    cycle = words[begin : begin + period]
    return (words[:begin] + cycle * (-(-(n - begin) // period)))[:n]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), rewrite=repeated_from)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.select("doc_id", "runs", "collapsed", longest.alias("longest")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"), F.expr("longest.length * 1000 div -longest.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    white = whitening.whiten(vectors, whitening.fit_whitening(vectors))
    return white.select("vec_id", "component", "n", F.expr("try_cast(deviation AS long)").alias("deviation"), "whitened", "explained", "identity_error")


QUERIES = {f.__name__: f for f in (op1_language_id, op2_line_dedup, op3_packing, op4_jaccard_join, op5_rule_ensemble, op6_url_filters, op7_decontaminate, op8_quality_rules, op9_suffix_dedup, op10_toxicity, op11_language_model, op12_periodic_runs, op13_whitening)}
