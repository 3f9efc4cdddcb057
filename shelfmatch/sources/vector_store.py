"""Vectors kept by the text they are made of: a text is encoded once, whichever product, shop or run it comes from.

The store is a folder of parquet files per encoder, with (vector_key, embedding) rows that are only ever added. The key
is a hash of the encoder's name and the text, so a changed text or another encoder never gets an old vector.
"""

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.operators.embedding import encode

VECTORS = "vector_key string, embedding array<float>"


def vector_key(text: Column, encoder_id: str) -> Column:
    """A null text is encoded as an empty one."""
    return F.sha2(F.concat(F.lit(f"{encoder_id}\u0001"), F.coalesce(text, F.lit(""))), 256)


def _folder(path: str, encoder_id: str) -> str:
    return f"{path}/{hashlib.sha256(encoder_id.encode()).hexdigest()[:16]}"


def read(spark: SparkSession, path: str, encoder_id: str) -> DataFrame:
    """(vector_key, embedding) of all that is stored; a key that two runs stored at once counts once."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_folder(path, encoder_id))
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], VECTORS)
    return spark.read.schema(VECTORS).parquet(_folder(path, encoder_id)).dropDuplicates(["vector_key"])


def add_missing(products: DataFrame, path: str, encoder_id: str, make_encoder, column="product_text") -> None:
    """Encode the texts that have no vector yet and append them. A failed run leaves whole vectors or none; the next one
    encodes the rest."""
    spark = products.sparkSession
    texts = products.select(vector_key(F.col(column), encoder_id).alias("vector_key"), column).dropDuplicates(["vector_key"])
    fresh = texts.join(read(spark, path, encoder_id).select("vector_key"), "vector_key", "left_anti")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # the encoder is the costly part: dealt over all of them
    encoded = encode(fresh.repartition(tasks, "vector_key"), column, make_encoder).select("vector_key", "embedding")
    encoded.write.mode("append").parquet(_folder(path, encoder_id))


def with_vectors(products: DataFrame, path: str, encoder_id: str, make_encoder, column="product_text") -> DataFrame:
    """The products with their ``embedding`` from the store, which gets the missing ones first. ``products`` is read
    twice, so it should be a stored table."""
    add_missing(products, path, encoder_id, make_encoder, column)
    keyed = products.withColumn("vector_key", vector_key(F.col(column), encoder_id))
    return keyed.join(read(products.sparkSession, path, encoder_id), "vector_key").drop("vector_key")
