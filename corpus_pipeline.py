"""The corpus pipeline: five stages over ``documents``, each stored and read back as the input of the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.llm import decontaminate, minhash, packing, pseudonyms, toxicity
from goldpan.llm.common import stored, table
from goldpan.llm.queries import KEY, TOKENIZER, held_out


def unused(docs: DataFrame, name: str) -> str:
    """``name``, made longer until ``docs`` has no such column in any case of letters."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def rows_of(docs: DataFrame, row: str) -> DataFrame:
    """``docs`` with a key ``row`` made of each row's id and text: it tells rows without an id, or with the same id, apart.

    The key is a function of the row, so that it is the same whenever it is computed; rows with equal ids and texts share it.
    """
    # a null and its name as text differ, and so do a null text and an empty one
    parts = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in (F.col("doc_id").cast("string"), F.col("text"))]
    return docs.withColumn(row, F.sha2(F.concat(*parts), 256))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled rows of ``docs``, scores below its threshold.

    Null and empty texts are scored like others, every row of those that repeat by itself; other columns stay, whatever their names, and an
    empty table gives an empty result.
    """
    score = unused(docs, "toxicity_score")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), lambda i: ~held_out(i))
    return toxicity.score(docs, model, name=score).where(F.col(score) < toxicity.THRESHOLD).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that with the smallest id (then digest of the row); rows without an id stay.

    Rows that share an id are documents of their own, but of those with equal texts, one is kept. Texts that are null or without words link
    with nothing; other columns stay, whatever their names, and an empty table gives an empty result.
    """
    row = unused(docs, "row")
    has_id = docs.where("doc_id IS NOT NULL")
    if has_id.groupBy("doc_id").count().where("count > 1").isEmpty():
        dropped = minhash.near_duplicates(has_id, size=5).where("NOT kept").select("doc_id")
        return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)
    # keys of id and row sort as the ids do; they are long, so they are used only where ids repeat
    number = F.col("doc_id").cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(20,0)")
    whole = dict(docs.dtypes)["doc_id"] in ("tinyint", "smallint", "int", "bigint")
    name = F.lpad(number.cast("string"), 20, "0") if whole else F.col("doc_id").cast("string")
    rows = rows_of(docs, row)
    keyed = rows.where("doc_id IS NOT NULL").select(F.concat(name, F.lit("\x01"), row).alias("doc_id"), "text")
    dropped = minhash.near_duplicates(keyed, size=5).where("NOT kept").select(F.substring_index("doc_id", "\x01", -1).alias(row)).distinct()
    out = rows.join(dropped, row, "left_anti")
    # rows with equal ids and texts: one of them, the same each time
    twice = rows.where("doc_id IS NOT NULL").groupBy(row).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(row)
    one = out.join(twice, row, "left_semi").groupBy(row).agg(F.min(F.struct(*docs.columns)).alias("kept_row")).select("kept_row.*")
    return out.join(twice, row, "left_anti").select(docs.columns).union(one.select(docs.columns))


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item; a row is judged by its own text, whatever its id.

    Null and empty texts hold none, rows that repeat are judged alike; other columns stay, whatever their names, and an empty table gives an empty result.
    """
    row = unused(docs, "row")
    rows = rows_of(docs, row)
    found = decontaminate.contaminated(rows, table(spark, sf_dir, "benchmark"), id_col=row).select(F.col("doc_id").alias(row)).distinct()
    # few documents hold items
    return rows.join(found, row, "left_anti").select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms; null texts, other columns and repeated rows stay as they are, and so does an empty table."""
    return pseudonyms.pseudonymise(docs, KEY)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents at their places in training sequences; a null text is empty, repeated rows have pieces of their own, an empty table has none."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("toxicity", toxic),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", leaks),
    ("pii", personal_data),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Training, signatures and tokenizers have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None
