"""SNK1: compaction of the small files that the stream sink leaves.

A micro-batch writes a file for each shuffle partition and directory. The sink
records what it has committed in a log beside the data; this job reads through
the log, so that files of unfinished batches stay out, packs each directory's files by
size, rewrites the packs as one file each and publishes them as a new generation
by one rename. The stream's folder is never touched: it may run on meanwhile.

A generation folder holds the rewritten table and, hidden from readers, the list
of files it replaces. A reader takes all generations and what the log has beyond
them. A killed run leaves a draft whose name starts with an underscore and
changes nothing. On object stores a rename is a copy: publish there only from
one job at a time, as this one does. The driver holds file names, as Spark's own
file index does.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from devpulse.operators.joins import join_small

TARGET_BYTES = 128 << 20


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def children(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Full names of the entries of a folder that start with ``prefix``, sorted; none if there is no folder."""
    fs, at = _folder(spark, path)
    if not fs.exists(at):
        return []
    return sorted(str(s.getPath()) for s in fs.listStatus(at) if s.getPath().getName().startswith(prefix))


def publish(spark: SparkSession, draft: str, final: str) -> bool:
    """Rename a finished draft; False (the draft stays) if the name is taken."""
    fs, to = _folder(spark, final)
    fs.mkdirs(to.getParent())
    if fs.exists(to):
        return False
    if not fs.rename(_folder(spark, draft)[1], to):
        raise IOError(f"cannot rename {draft} to {final}")
    return True


def committed_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, size, directory`` of the files with rows that the stream sink under ``path`` has committed.

    Spark reads a sink's folder through the sink's log; only the files' own metadata is read here.
    """
    files = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("path"),
                                            F.col("_metadata.file_size").alias("size")).distinct()
    return files.withColumn("directory", F.regexp_replace("path", "/[^/]*$", ""))


def packs(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """``path, directory, pack``: a directory's files in order, a new pack for every ``target_bytes``.

    A directory of b bytes has at most b / target + 1 packs, each of at most the target and one file.
    """
    before = Window.partitionBy("directory").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("path", "directory", F.floor(
        F.coalesce(F.sum("size").over(before), F.lit(0)) / F.lit(target_bytes)).cast("long").alias("pack"))


def generations(spark: SparkSession, compacted: str) -> list[str]:
    return children(spark, compacted, "gen-")


def _replaced(spark: SparkSession, compacted: str) -> DataFrame:
    """``path`` of the files that generations hold already."""
    found = [spark.read.parquet(f"{g}/_sources") for g in generations(spark, compacted)]
    out = spark.createDataFrame([], "path string")
    for one in found:
        out = out.union(one.select("path"))
    return out


def _beyond(spark: SparkSession, path: str, compacted: str) -> DataFrame:
    replaced = _replaced(spark, compacted)
    return committed_files(spark, path).join(replaced, "path", "left_anti")


def _rows(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Rows of the named files. The sink's log knows the files, so none is looked up, and the others are not opened."""
    names = ["'" + n.replace("\\", "\\\\").replace("'", "\\'") + "'" for n in names]
    return spark.read.parquet(path).where(f"_metadata.file_path IN ({', '.join(names)})")


def compact(spark: SparkSession, path: str, compacted: str, partition_by, target_bytes: int = TARGET_BYTES) -> str | None:
    """Rewrite what the sink has committed since the last generation; the new generation's folder, None if nothing is new."""
    plan = packs(_beyond(spark, path, compacted), target_bytes)
    draft = f"{compacted}/_draft-{uuid.uuid4().hex}"
    plan.write.parquet(f"{draft}/_sources")
    plan = spark.read.parquet(f"{draft}/_sources")
    names = [r["path"] for r in plan.select("path").collect()]
    if not names:
        return None
    rows = _rows(spark, path, names).withColumn("path", F.col("_metadata.file_path"))
    # One task, hence one file, for each pack.
    (join_small(rows, plan, ["path"]).repartition("directory", "pack").drop("path", "directory", "pack")
     .write.mode("append").partitionBy(*partition_by).parquet(f"{draft}/rows"))
    final = f"{compacted}/gen-{len(generations(spark, compacted)):06d}"
    if not publish(spark, draft, final):
        raise IOError(f"{final} is there already: another compaction ran meanwhile")
    return final


def read_compacted(spark: SparkSession, path: str, compacted: str) -> DataFrame:
    """The sink's committed rows, from the generations and the files beyond them."""
    names = [r["path"] for r in _beyond(spark, path, compacted).select("path").collect()]
    parts = [spark.read.parquet(f"{g}/rows") for g in generations(spark, compacted)]
    if names or not parts:
        parts.append(_rows(spark, path, names) if names else spark.read.parquet(path))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
