"""The registered queries of this subpackage, thin over its operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspark.storage import scratch_path

from . import ann, chat, decontam, langid, lexical, licenses, neardup, negatives, oracle, pieces, quality, secretscan, tokenstore, urlfilter
from .common import held_out, table


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.sql("select * from values (-7L, 0L, 'user', :t), (-7L, 1L, 'assistant', :t) as t(conv_id, turn, role, text)", args={"t": control})
    return chat.digests(chat.windows(rows.unionByName(extra)))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found, lang, score = langid.predict(docs.select("doc_id", "text"), langid.train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(lang).alias("lang_pred"), F.col(score).alias("score"))


#: The listed urls: host, path, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found, names = urlfilter.judge(pages, spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))
    return found.select("page_id", *names)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def benchmark_longest_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest verbatim match of every benchmark item in the documents, of any length."""
    return decontam.item_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    tokenstore.write_store(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokenstore.document_index(tokenstore.open_store(spark, path))


def op5_token_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single tokens of every document by random access: the first, the middle and the last one."""
    path = scratch_path(spark, "tokens")
    tokenstore.write_store(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    store = tokenstore.open_store(spark, path)
    n = F.col("n_tokens")
    wanted = store.select("doc_id", F.explode(F.array(F.lit(0).cast("bigint"), F.floor(n / 2), n - 1)).alias("at"))
    return tokenstore.lookup(store, wanted)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_licenses_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with lines as blocks."""
    return licenses.scan(table(spark, sf_dir, "documents"), wrapped=False)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored, name = quality.score(docs.select("doc_id", "text"), quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(name).alias("score"), (F.col(name) >= quality.CUT).cast("int").alias("predicted"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", label), F.col("id") % 50 == 0)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secretscan.digests(docs, secretscan.train(docs))


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_language": op2_language,
    "op3_url_filter": op3_url_filter,
    "op4_decontamination": op4_decontamination,
    "benchmark_longest_matches": benchmark_longest_matches,
    "op5_token_store": op5_token_store,
    "op5_token_lookup": op5_token_lookup,
    "op6_licenses": op6_licenses,
    "op6_licenses_lines": op6_licenses_lines,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_quality": op8_quality,
    "op9_neighbours": op9_neighbours,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_lexical_search": op12_lexical_search,
    "op13_secrets": op13_secrets,
}
#: The others learn a model, search approximately, or need a tokenizer.
ORACLE_SQL: dict[str, str] = {
    "op1_chat_format": oracle.OP1,
    "op3_url_filter": oracle.OP3,
    "op4_decontamination": oracle.OP4,
    "op6_licenses": oracle.OP6,
    "op6_licenses_lines": oracle.OP6_LINES,
    "op7_near_duplicates": oracle.OP7,
    "op11_hard_negatives": oracle.OP11,
    "op12_lexical_search": oracle.OP12,
}
