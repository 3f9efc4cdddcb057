"""The incremental load as a stream of files: pages that arrive are read once and appended as product rows.

The checkpoint remembers which files are done, so a run after a failure continues without repeating rows. The work is
row by row, hence no state and no watermark.
"""

from pyspark.sql import DataFrame, SparkSession

from shelfmatch import schema
from shelfmatch.operators import pages
from shelfmatch.sources import staging


def load_new_pages(spark: SparkSession, source: str, target: str, checkpoint: str) -> None:
    """Process all page files not seen before, then stop."""
    arriving = spark.readStream.schema(schema.PAGES).parquet(source)
    rows = pages.usable_products(pages.product_rows(arriving))
    query = (
        rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def load_pages_with_rejects(spark: SparkSession, source: str, products: str, rejects: str, checkpoint: str, columns: str = schema.PAGES) -> None:
    """Process all page files not seen before, then stop: usable rows go to ``products``, one folder per batch and
    ``sub_cat``; pages that are not usable go to ``rejects``, one folder per batch, as (href, sub_cat, problem).

    A batch replaces what it has written before, so a batch that failed between the two sinks, or is run again after a
    failure, leaves each of its pages in one of them, once. Its pages are parsed once, into a staged table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        begun = staging.mark(batch.sparkSession)
        rows = staging.stage(pages.product_rows(batch), "parsed-pages")
        pages.usable_products(rows).write.mode("overwrite").partitionBy("sub_cat").parquet(f"{products}/batch={batch_id}")
        bad = rows.where("problem is not null").select("href", "sub_cat", "problem")
        bad.write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
        staging.drop(batch.sparkSession, staging.since(batch.sparkSession, begun))

    arriving = spark.readStream.schema(columns).parquet(source)
    query = arriving.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
