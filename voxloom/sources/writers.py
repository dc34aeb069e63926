"""Writers: versioned tables, partition replacement, shards, manifests, failed lists, documents."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.operators.sequence import batches_before_exceed
from voxloom.storage import delete_path


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file: written beside it, then moved over it in one step, so that a reader finds the old or the new."""
    jvm, where, fs = _fs(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(path + ".draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(draft), fs.makeQualified(where), over)


def write_document(df: DataFrame, path: str) -> None:
    """A one-row table as a JSON document."""
    row = df.first()
    write_text(df.sparkSession, path, json.dumps(row.asDict(recursive=True) if row else {}, ensure_ascii=False, indent=2, default=str))


class Versions:
    """Numbered versions of a folder: each in ``v1``, ``v2``, ..., complete once its marker file is there.

    A marker is written last, new and never over another, so no crash leaves the folder without its last complete
    version, and of two writers of one number the second fails.  What a crash left incomplete is written anew.
    """

    MARKER = "_COMPLETE"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def folder(self, version: int) -> str:
        """Folder of a version."""
        return f"{self.path}/v{version}"

    def _found(self) -> dict[int, bool]:
        jvm, where, fs = _fs(self.spark, self.path)
        if not fs.exists(where):
            return {}
        names = [status.getPath().getName() for status in fs.listStatus(where)]
        numbers = [int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit()]
        return {n: fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.folder(n)}/{self.MARKER}")) for n in numbers}

    def current(self) -> int:
        """The last complete version; 0 before the first.

        Later versions without any complete one are an error, never a new start: something removed the markers.
        """
        found = self._found()
        complete = [n for n, done in found.items() if done]
        if not complete and any(n > 1 for n in found):
            raise RuntimeError(f"{self.path} has versions, but none is complete")
        return max(complete, default=0)

    def note(self, version: int) -> dict:
        """What was noted when a version was completed."""
        jvm, where, fs = _fs(self.spark, f"{self.folder(version)}/{self.MARKER}")
        stream = fs.open(where)
        try:
            return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def complete(self, version: int, note: dict | None = None) -> None:
        """Declare a version complete; its tables must have been written."""
        path = f"{self.folder(version)}/{self.MARKER}"
        jvm, where, fs = _fs(self.spark, path)
        draft = jvm.org.apache.hadoop.fs.Path(f"{self.folder(version)}/.{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(note or {}).encode()))
        out.close()
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(draft), fs.makeQualified(where), none)

    def drop(self, version: int) -> None:
        """Delete a version, its marker first."""
        delete_path(self.spark, f"{self.folder(version)}/{self.MARKER}")
        delete_path(self.spark, self.folder(version))


class VersionedTable:
    """A table replaced as a whole, each version in its own folder.

    Readers of a version aren't disturbed, and a query may read the version that it replaces.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.versions = spark, Versions(spark, path)

    def version(self) -> int:
        """The current version; 0 before the first."""
        return self.versions.current()

    def read(self) -> DataFrame:
        """The current version."""
        if not (v := self.version()):
            raise FileNotFoundError(self.versions.path)
        return self.spark.read.parquet(f"{self.versions.folder(v)}/rows")

    def replace(self, df: DataFrame, keep: int = 2) -> int:
        """Write a new version; the last ``keep`` stay."""
        v = self.version() + 1
        df.write.mode("overwrite").parquet(f"{self.versions.folder(v)}/rows")
        self.versions.complete(v)
        if v > keep:
            self.versions.drop(v - keep)
        return v


def append_lines(df: DataFrame, path: str) -> None:
    """Append JSON lines."""
    df.write.mode("append").json(path)


def _partition_path(spark: SparkSession, path: str, key: str, value: object) -> str:
    escaped = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))
    return f"{path}/{key}={escaped}"


def replace_partitions(df: DataFrame, path: str, key: str = "video_id", judged: DataFrame | None = None) -> None:
    """Replace the partitions of the keys that ``df`` holds, others stay: running again is harmless.

    ``judged`` has all keys that this run decided on: those without a row in ``df`` lose their partition, so a key
    that was emptied doesn't keep its rows of before.  Emptied keys stream through the driver one by one, as deleting
    is work for the file system only.
    """
    spark = df.sparkSession
    df.repartition(key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)
    if judged is not None:
        emptied = judged.select(key).filter(F.col(key).isNotNull()).distinct().join(df.select(key).distinct(), key, "left_anti")
        for row in emptied.toLocalIterator():
            delete_path(spark, _partition_path(spark, path, key, row[0]))


def drop_video(spark: SparkSession, path: str, video_id: str, key: str = "video_id") -> int:
    """Delete one key's partition; returns the rows that it had."""
    partition = _partition_path(spark, path, key, video_id)
    _, where, fs = _fs(spark, partition)
    if not fs.exists(where):
        return 0
    rows = spark.read.parquet(partition).count()
    fs.delete(where, True)
    return rows


def write_split(table: DataFrame, kept_path: str, rejected_path: str) -> None:
    """Kept and rejected rows of gates, each by video.

    A video that was judged again and lost its last kept, or its last rejected, row vanishes there.
    """
    replace_partitions(table.filter("reject_code IS NULL").drop("reject_code", "reject_value"), kept_path, judged=table)
    replace_partitions(table.filter("reject_code IS NOT NULL"), rejected_path, judged=table)


def write_shards(table: DataFrame, path: str, by: list[str]) -> None:
    """Typed parquet by voice and shard, compressed by zstd at level 3; ``by`` names the partition columns."""
    table.repartition(*by).write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", "3").partitionBy(*by).parquet(path)


def write_failed(results: DataFrame, path: str) -> int:
    """Failed sources as text that can be fed again; without any, the file goes. Returns their number."""
    spark = results.sparkSession
    failed = results.filter("error IS NOT NULL AND url IS NOT NULL").select(F.col("url").alias("value"))
    n = failed.count()
    if n:
        failed.write.mode("overwrite").text(path)
    else:
        delete_path(spark, path)
    return n


def write_manifest(entries: DataFrame, path: str) -> None:
    """JSON lines made before (``value``), in files of their own."""
    entries.select("value").write.mode("overwrite").text(path)


def markdown_card(title: str, stats: dict[str, object], notes: str = "") -> str:
    """A card with a table of figures."""
    rows = "\n".join(f"| {k} | {v} |" for k, v in stats.items())
    return f"# {title}\n\n{notes}\n\n| figure | value |\n| --- | --- |\n{rows}\n"


def write_word_cache(words: DataFrame, path: str) -> None:
    """Recognized words by video, times to three and scores to four decimals; a video written again is replaced."""
    rounded = words.select("video_id", "pos", "text", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), F.round("score", 4).alias("score"))
    replace_partitions(rounded.filter(F.col("video_id").isNotNull()), path)


def write_retranscribed(folder: str, rows: DataFrame, updated: DataFrame, orphans: DataFrame, diffs: DataFrame, report: DataFrame) -> None:
    """Tables of a renewed transcription: the rows of before are kept once, and never written over."""
    spark = rows.sparkSession
    _, backup, fs = _fs(spark, f"{folder}/before/_SUCCESS")
    if not fs.exists(backup):
        rows.write.mode("overwrite").parquet(f"{folder}/before")
    for name, table in (("metadata", updated), ("orphans", orphans), ("diffs", diffs)):
        VersionedTable(spark, f"{folder}/{name}").replace(table)
    write_document(report, f"{folder}/report.json")


def delete_spent(files: DataFrame) -> int:
    """Delete the listed files (``path``, ``is_local``, ``keep``) but for local sources and those to keep; their number.

    Paths stream through the driver one by one.
    """
    spark, n = files.sparkSession, 0
    for row in files.filter("path IS NOT NULL AND NOT coalesce(is_local, true) AND NOT coalesce(keep, false)").select("path").distinct().toLocalIterator():
        delete_path(spark, row["path"])
        n += 1
    return n


def commit_batches(files: DataFrame, most_files: int, most_bytes: int) -> DataFrame:
    """Adds ``batch`` to files (``folder``, ``path``, ``bytes``): commits of a folder close before they grow too large."""
    return batches_before_exceed(files, ["folder"], ["path"], "bytes", most_bytes, most_files)


def to_upload(files: DataFrame, listing: DataFrame, key: str = "path") -> DataFrame:
    """Files that a store's listing doesn't have."""
    return files.join(listing.select(key).distinct(), key, "left_anti")
