"""The corpus pipeline: language ID, line dedup, SimHash near-dedup, benchmark decontamination, BPE.

Every stage takes the rows that the one before kept, with any columns, and returns all of them (the last adds ``ids``
and ``decoded``). Empty tables give empty results. Texts are read whole, whatever their length.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.llm import bpe, decontaminate, language, lines, simhash
from shelfmatch.llm.common import quoted, spare, table
from shelfmatch.llm.queries import language_model, vocabulary
from shelfmatch.sources import staging

# What a task holds of whole texts at a time, in the JVM and again in Python: session settings, as the writer of a stage
# need not be ours. A task writes its rows in groups of 16 MB and sends them to Python in batches of 4 MB.
BOUNDS = {
    "parquet.block.size": str(16 << 20),
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def bound_batches(spark: SparkSession) -> None:
    for key, value in BOUNDS.items():
        spark.conf.set(key, value)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no learned language go: null and empty texts, texts without a letter, and those whose best language
    holds fewer than a tenth of their n-grams. Ties between languages keep the row; repeated rows stay or go together.
    The filters are learned from the rows whose ``crc32(doc_id)`` is no multiple of 5; rows without an id are not learned
    from. If no row has a ``lang``, no language is known and all go."""
    bound_batches(spark)
    return language.drop_unidentified(docs, language_model(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents hold stay in the one with the smallest ``doc_id``; ``n_chars``, if there is such a
    column, follows the text of documents that lost lines. Null texts stay null; rows without an id keep all lines and
    are not counted; rows of one id count as one document."""
    bound_batches(spark)
    own = [c for c in docs.columns if c.lower() in ("n_lines", "n_dropped")]
    apart = dict(zip(own, spare(docs, *[f"own_{c}" for c in own])))
    found = lines.drop_repeated_lines(docs.withColumnsRenamed(apart))
    changed = F.col("n_dropped") > 0
    columns = []
    for c in docs.columns:
        value = quoted(apart.get(c, c))
        if c == "n_chars":
            value = F.when(changed, F.char_length("text").cast(docs.schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    return found.select(*columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest ``doc_id``. Texts without words are
    near-duplicates of each other (fingerprint zero); see ``simhash.drop_near_duplicates`` for repeated rows and rows
    without an id."""
    bound_batches(spark)
    return simhash.drop_near_duplicates(docs)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, whether the item has an id or not. Null and empty texts stay; repeated
    rows stay or go together."""
    bound_batches(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents with their token ids (``ids``) and the text decoded from them (``decoded``); columns of these
    names are replaced. Null and empty texts have no ids and an empty decoded text. All rows stay."""
    bound_batches(spark)
    source = vocabulary()
    return bpe.decode(bpe.encode(docs, source), source)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_documents),
    ("decontamination", decontaminate_documents),
    ("bpe", encode_documents),
]
ORACLE_SQL = None  # language ID, SimHash and BPE have no SQL form; tests compare the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written as Parquet and read again, and what was staged for it
    and before it is deleted then."""
    docs = table(spark, sf_dir, "documents")
    last = None
    for name, stage in STAGES:
        begun = staging.mark(spark)
        result = stage(spark, docs, sf_dir)
        path = staging.fresh_path(spark, f"pipeline-{name}")
        result.write.parquet(path)
        staging.drop(spark, [p for p in [*staging.since(spark, begun), last] if p and p != path])
        docs, last = spark.read.parquet(path), path
    return docs
