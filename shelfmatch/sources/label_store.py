"""Labels kept in a folder that is updated whole or not at all.

The rows lie in buckets of their key's hash. An update rewrites only the buckets it touches, into a folder of its own, and
then adds a manifest that says where each bucket lies now. Readers follow the newest manifest, so they see the labels
before or after an update and nothing between; a run that dies before its manifest leaves the old labels and files that
``remove_unused`` deletes. Of two updates begun on one version the later one fails and can be run again.
"""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.operators.labels import upsert_labels

BUCKETS = 64


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The versions there are, oldest first; none if nothing was ever saved."""
    path, files = _path(spark, f"{folder}/manifests")
    names = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))


def _manifest(spark: SparkSession, folder: str, version: int | None = None) -> dict:
    found = versions(spark, folder)
    if not found or version is not None and version not in found:
        raise ValueError(f"{folder} has no version {'at all' if version is None else version}")
    path, files = _path(spark, f"{folder}/manifests/{version or found[-1]:012d}.json")
    stream = files.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _commit(spark: SparkSession, folder: str, manifest: dict) -> None:
    """The manifest is written beside its place and renamed into it, which fails if that version is there already."""
    draft, files = _path(spark, f"{folder}/manifests/.{uuid.uuid4().hex}.draft")
    stream = files.create(draft, False)
    stream.write(bytearray(json.dumps(manifest), "utf-8"))
    stream.close()
    place, _ = _path(spark, f"{folder}/manifests/{manifest['version']:012d}.json")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, place, options)
    except Exception as error:
        files.delete(draft, False)
        if "FileAlreadyExists" in str(error):
            raise RuntimeError(f"another update of {folder} came first; run this one again") from error
        raise


def _bucket(key: list[str], buckets: int):
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _rows(spark: SparkSession, manifest: dict, buckets=None) -> DataFrame:
    folders = [f for b, f in manifest["folders"].items() if buckets is None or int(b) in buckets]
    return spark.read.schema(manifest["columns"]).parquet(*folders) if folders else spark.createDataFrame([], manifest["columns"])


def read(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The labels of the newest version, or of an older one that is still there."""
    return _rows(spark, _manifest(spark, folder, version))


def _save(labels: DataFrame, folder: str, manifest: dict) -> None:
    """Write the rows as buckets of the next version and commit it; buckets that get no rows keep their folder."""
    spark, key, n = labels.sparkSession, manifest["key"], manifest["buckets"]
    data = f"{folder}/data/{manifest['version']:012d}-{uuid.uuid4().hex}"
    placed = labels.withColumn("label_bucket", _bucket(key, n))
    placed.repartition(n, "label_bucket").write.partitionBy("label_bucket").parquet(data)
    path, files = _path(spark, data)
    written = [f.getPath().getName() for f in files.listStatus(path) if f.isDirectory()]
    moved = {name.split("=")[1]: f"{data}/{name}" for name in written}
    _commit(spark, folder, manifest | {"folders": manifest["folders"] | moved})


def create(labels: DataFrame, folder: str, key: list[str], buckets: int = BUCKETS) -> None:
    """Save the first version. ``key`` says which label a later one replaces; it has to be unique in ``labels``."""
    if versions(labels.sparkSession, folder):
        raise ValueError(f"{folder} already has labels")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in labels.schema)
    _save(labels, folder, {"version": 1, "key": key, "buckets": buckets, "columns": columns, "folders": {}})


def update(updates: DataFrame, folder: str) -> int:
    """Replace or add the labels of ``updates`` (the stored columns and an increasing ``version`` >= 1), as
    ``upsert_labels`` does. Returns the version of the store that holds them. ``updates`` is read twice."""
    spark = updates.sparkSession
    manifest = _manifest(spark, folder)
    touched = updates.select(_bucket(manifest["key"], manifest["buckets"]).alias("b")).distinct()  # as many rows as buckets at most
    buckets = {row["b"] for row in touched.collect()}
    if not buckets:
        return manifest["version"]
    merged = upsert_labels(_rows(spark, manifest, buckets), updates, manifest["key"])
    _save(merged, folder, manifest | {"version": manifest["version"] + 1})
    return manifest["version"] + 1


def remove_unused(spark: SparkSession, folder: str, keep: int = 1) -> None:
    """Delete all but the newest ``keep`` versions and whatever no version reads. Not while an update is running."""
    found = versions(spark, folder)
    kept, gone = found[-keep:], found[:-keep]
    used = {f.rsplit("/", 2)[1] for v in kept for f in _manifest(spark, folder, v)["folders"].values()}
    for version in gone:  # first the manifests, so that none points at missing files
        path, files = _path(spark, f"{folder}/manifests/{version:012d}.json")
        files.delete(path, False)
    path, files = _path(spark, f"{folder}/data")
    for status in files.listStatus(path) if files.exists(path) else []:
        if status.getPath().getName() not in used:
            files.delete(status.getPath(), True)
