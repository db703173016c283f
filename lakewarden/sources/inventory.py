"""File inventories."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Folders at which listing is handed to tasks, and files in a batch.
FOLDERS, BATCH = 512, 10_000
#: Folder names that say what the objects below them are, and when they came to be if the next name is such a time.
KINDS = {".snapshot": "snapshot", ".version": "version"}
CREATED = "yyyyMMdd'T'HHmmss"


def _listing_source() -> type[DataSource]:
    # Classes made here travel to the workers by value: they need not have this package.
    class Folder(InputPartition):
        """A folder to list: whole, or only the files directly in it."""

        def __init__(self, path: str, whole: bool):
            super().__init__((path, whole))
            self.path, self.whole = path, whole

    def store_of(root: str):
        from pyarrow import fs

        if root.startswith("file:") or "://" not in root:
            return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", root).rstrip("/") or "/"
        store, path = fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", root))
        return store, path.rstrip("/")

    class Reader(DataSourceReader):
        def __init__(self, root: str, folders: int):
            self.root, self.folders = root, folders

        def partitions(self):
            """Folders level by level, until there are enough of them; a listing of names only."""
            from pyarrow import fs

            store, top = store_of(self.root)
            level, out = [top], []
            while level and len(level) < self.folders:
                below = []
                for folder in level:
                    # Seen one by one, as a folder may hold very many files.
                    below += [i.path for i in store.get_file_info(fs.FileSelector(folder)) if i.type == fs.FileType.Directory]
                if not below:
                    break
                out += [Folder(folder, False) for folder in level]
                level = below
            return out + [Folder(folder, True) for folder in level]

        def read(self, partition):
            import pyarrow as pa
            from pyarrow import fs

            store, top = store_of(self.root)
            names = ["path", "bytes", "modified_at"]
            kinds = [pa.string(), pa.int64(), pa.timestamp("us")]
            rows, folders = [], [partition.path]
            while folders:
                for info in store.get_file_info(fs.FileSelector(folders.pop())):
                    if info.type == fs.FileType.Directory:
                        folders += [info.path] if partition.whole else []
                    else:
                        moment = info.mtime.replace(tzinfo=None) if info.mtime else None
                        rows.append((info.path[len(top) :].lstrip("/"), info.size, moment))
                    if len(rows) == BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    class Listing(DataSource):
        @classmethod
        def name(cls):
            return "lakewarden_listing"

        def schema(self):
            return "path string, bytes bigint, modified_at timestamp_ntz"

        def reader(self, schema):
            return Reader(self.options["root"], int(self.options["folders"]))

    return Listing


def _listed_by_spark(spark: SparkSession, root: str) -> DataFrame:
    """Files as Spark's own file index finds them, which keeps the list on the driver."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "modificationTime", "length")
    )
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString().rstrip("/") + "/"
    # Both sides name the same store; the root is cut off once, at the front.
    plain = F.regexp_replace("path", r"^[a-z0-9]+:/+", "/")
    relative = F.substr(plain, F.lit(len(re.sub(r"^[a-z0-9]+:/+", "/", base)) + 1))
    return files.select(
        relative.alias("path"), F.col("length").alias("bytes"), F.col("modificationTime").cast("timestamp_ntz").alias("modified_at")
    )


def object_inventory(
    spark: SparkSession, root: str, *, blob_type: str = "blockBlob", folders: int = FOLDERS, by_spark: bool | None = None
) -> DataFrame:
    """One row per file below ``root``: path, container, kind, blob_type, bytes, created_at, modified_at.

    These are the columns the lifecycle operators take. ``path`` is relative to ``root``; ``container`` is its first
    folder (null for files directly in ``root``). An object is a snapshot or a version if a folder above it is named
    ``.snapshot`` or ``.version``, else it is a base object; a time as the name of the next folder (20240131T235959) is
    when it was created. Other objects count as created when last modified: stored objects are written once.
    ``blob_type`` is the same for all, as file systems don't know any.

    The driver lists folder names down to a level of about ``folders`` of them; from there each folder is a task that
    walks it and hands on its files in batches, so no process ever holds the whole list. This works for local and
    mounted paths, S3, Google storage and HDFS. Other stores (``by_spark``) are listed by Spark's file index, which
    leaves out empty files and names that begin with a dot or an underscore. File content is never read.
    """
    scheme = root.partition(":")[0] if ":" in root.partition("/")[0] else "file"
    if by_spark is None:
        by_spark = scheme not in ("file", "s3", "s3a", "s3n", "gs", "hdfs")
    if by_spark:
        files = _listed_by_spark(spark, root)
    else:
        spark.dataSource.register(_listing_source())
        files = spark.read.format("lakewarden_listing").options(root=root, folders=str(folders)).load()
    path = F.col("path")
    kind, created = F.lit("base"), F.lit(None).cast("timestamp_ntz")
    for folder, name in KINDS.items():
        after = F.regexp_extract(path, rf"(?:^|/){re.escape(folder)}/([^/]+)/", 1)
        here = F.concat(F.lit("/"), path).contains(f"/{folder}/")
        kind = F.when(here, name).otherwise(kind)
        created = F.when(here, F.try_to_timestamp(after, F.lit(CREATED)).cast("timestamp_ntz")).otherwise(created)
    return files.select(
        "path",
        F.when(path.contains("/"), F.substring_index(path, "/", 1)).alias("container"),
        kind.alias("kind"),
        F.lit(blob_type).alias("blob_type"),
        "bytes",
        F.coalesce(created, "modified_at").alias("created_at"),
        "modified_at",
    )
