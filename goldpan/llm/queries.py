"""One query per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.llm import articles, chat, decontaminate, manifest, minhash, packing, pseudonyms, reference_sql, repeats, spelling, tokens, toxicity, vectors, warc
from goldpan.llm.common import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Demonstration key; a deployment passes its own.
KEY = "goldpan-demonstration-key"


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), TOKENIZER)


def op2_template_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that hold benchmark items, one row per document and item; other documents have no row."""
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_prefix_doubling(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.removed(table(spark, folder, "documents"))


def op4_warc_members(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(table(spark, folder, "pages"))


def op5_rotated_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.linked(table(spark, folder, "embeddings"))


def op6_prefix_target_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one more, -7, whose texts consist of control strings; read back from the formatted examples."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).selectExpr("-7L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role", "'</s>[INST] ok [/INST]' AS text")
    return chat.read_back(chat.examples(turns.unionByName(own)))


def op7_feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, KEY, count="n_replaced")


def op8_min_max_hashing(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def op9_two_pass_articles(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return articles.extract(pages).withColumn("n_chars", F.length("text").cast("long"))


def op10_counterfactual_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"), lambda i: ~held_out(i))
    scored = toxicity.score(docs, model).withColumn("held_out", held_out(F.col("doc_id")))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op12_merkle_descent(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return manifest.proven(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)


def op13_spliced_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.counted(table(spark, folder, "documents"), WORD_VOCABULARY)


def queries() -> dict:
    found = {k: f for k, f in globals().items() if k.startswith("op")}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return reference_sql.oracle_sql()
