"""Line dedup: lines that several documents hold stay in one of them only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import ascii_lower, join_counted, quoted, spare, without
from shelfmatch.sources.staging import stage

LINE_SPACE = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space at both ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(LINE_SPACE)))


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def drop_repeated_lines(docs: DataFrame, min_chars: int = 10, min_documents: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Drop each line whose key has ``min_chars`` code points and occurs in ``min_documents`` documents, except in the
    smallest ``doc_id`` that holds it. Adds ``n_lines`` (before dropping) and ``n_dropped``.

    Null or empty texts are one empty line and stay as they are. Rows without a ``doc_id`` pass unchanged and are not
    counted. Rows that share a ``doc_id`` are one document: a line in two of them counts once. Input columns named
    ``n_lines`` or ``n_dropped`` are replaced.

    Only (document, position, 128-bit hash) rows are grouped and joined. The first document of a hash comes from
    partial aggregation and goes back to the hash's rows, by broadcast if it has very many (``join_counted``), so a line
    that a third of all documents hold is never gathered. The text meets the list of its dropped positions in one join.
    """
    docs = without(docs, "n_lines", "n_dropped")
    line = F.col("line")
    rows = docs.select(quoted(doc_id).alias("id"), F.xxhash64(quoted(text)).alias("version"), F.posexplode(text_lines(quoted(text))).alias("pos", "line"))
    keyed = rows.where("id is not null").select("id", "version", "pos", line_key(line).alias("key")).where(F.char_length("key") >= min_chars)
    hashed = stage(keyed.select("id", "version", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")), "lines")

    if min_documents <= 2:
        counted = hashed.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).where("first < last")
    else:
        once = hashed.groupBy("h1", "h2", "id").agg(F.count(F.lit(1)).alias("times"))
        counted = once.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("ids"), F.sum("times").alias("n")).where(F.col("ids") >= min_documents)
    repeated = stage(counted.select("h1", "h2", "first", "n"), "repeated-lines")
    met = join_counted(hashed, repeated, ["h1", "h2"], hashed.count())
    dropped = met.where("id <> first").groupBy("id", "version").agg(F.collect_set("pos").alias("gone"))
    id_, version, gone, lines, n = spare(docs, "id", "version", "gone", "lines", "n")
    side = dropped.select(F.col("id").alias(id_), F.col("version").alias(version), F.col("gone").alias(gone))
    joined = docs.join(side, (quoted(doc_id) == F.col(id_)) & (F.xxhash64(quoted(text)) == F.col(version)), "left")
    joined = joined.withColumn(lines, text_lines(quoted(text))).withColumn(n, F.size(lines))
    kept = F.array_except(F.sequence(F.lit(0), F.col(n) - 1), F.col(gone))
    left = F.concat_ws("\n", F.transform(kept, lambda i: F.get(F.col(lines), i)))
    return joined.select(
        *[F.when(F.col(gone).isNull(), quoted(c)).otherwise(left).alias(c) if c == text else quoted(c) for c in docs.columns],
        F.col(n).cast("long").alias("n_lines"),
        F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long").alias("n_dropped"),
    )
