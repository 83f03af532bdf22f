"""File-system helpers.

Driver side: existence checks and deletes through the Hadoop FileSystem of the
session (works for any scheme the cluster is configured for). Executor side:
``write_file`` for writing a file from a task.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return bool(fs.exists(p))


def has_entries(spark: SparkSession, path: str) -> bool:
    """True when ``path`` is a folder with at least one visible entry (or a file)."""
    fs, p = _hadoop_path(spark, path)
    if not fs.exists(p):
        return False
    if fs.isFile(p):
        return True
    it = fs.listStatusIterator(p)
    while it.hasNext():
        name = it.next().getPath().getName()
        if _visible(name):
            return True
    return False


def _visible(name: str) -> bool:
    """Spark's listing rule: '_' and '.' names are hidden, except partition folders."""
    if name.startswith("."):
        return False
    return not name.startswith("_") or "=" in name


LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def bound_listing(spark: SparkSession) -> None:
    """Lets the session's listing jobs have twice as many tasks as run at once, at most. By default a
    listed path is a task of its own, so naming the files of a micro-batch costs more than loading them."""
    most = 2 * spark.sparkContext.defaultParallelism
    if int(spark.conf.get(LISTING_TASKS)) > most:
        spark.conf.set(LISTING_TASKS, most)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


_URI = re.compile(r"^([a-zA-Z][a-zA-Z0-9+.-]*):(//[^/]*)?(/.*)$")
_ARROW_SCHEME = {"s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gs", "hdfs": "hdfs", "abfs": "abfs", "abfss": "abfs"}


def located(path: str):
    """(Arrow file system, its own path, what precedes that path in names as Spark writes them)."""
    import pyarrow.fs as pafs

    m = _URI.match(path)
    if m is None or m.group(1).lower() == "file":
        return pafs.LocalFileSystem(), (path if m is None else m.group(3)), "file:"
    scheme, authority, rest = m.group(1).lower(), (m.group(2) or "")[2:], m.group(3)
    fs, _ = pafs.FileSystem.from_uri(f"{_ARROW_SCHEME.get(scheme, scheme)}://{authority}/")
    if scheme in ("s3a", "s3n", "s3", "gs", "gcs"):
        return fs, f"{authority}{rest}", f"{scheme}://"
    return fs, rest, f"{scheme}://{authority}"


# Rows of a listing that leave a task at once.
LISTED_ROWS = 10_000


def list_below(depth: int, folders: bool):
    """Task body: of every folder ``path``, the visible entries ``depth`` levels below: its folders (path) or
    its files (path, length, modified in microseconds). A missing folder has none."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.fs as pafs

        def entries(fs, path: str, level: int):
            for x in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)):
                if not _visible(x.base_name):
                    continue
                is_folder = x.type == pafs.FileType.Directory
                if level < depth:
                    if is_folder:
                        yield from entries(fs, x.path, level + 1)
                elif is_folder == folders:
                    yield x

        def batch(rows: list) -> pa.RecordBatch:
            path = pa.array([r[0] for r in rows], pa.string())
            if folders:
                return pa.record_batch([path], ["path"])
            return pa.record_batch([path, pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())], ["path", "length", "modified"])

        rows = []
        for b in batches:
            for folder in b.column("path").to_pylist():
                fs, path, before = located(folder)
                for x in entries(fs, path.rstrip("/"), 1):
                    rows.append((before + x.path, x.size, x.mtime_ns // 1000 if x.mtime_ns else None))
                    if len(rows) >= LISTED_ROWS:
                        yield batch(rows)
                        rows = []
        yield batch(rows)

    return run


class StagedFile:
    """A file written under a hidden name beside its target (ignored by Spark's file listings)."""

    def __init__(self, path: str):
        import uuid

        self.fs, self.target, _ = located(path)
        parent, name = self.target.rsplit("/", 1)
        self.fs.create_dir(parent, recursive=True)
        self.staging = f"{parent}/.{name}.{uuid.uuid4().hex}.tmp"
        self.size = 0

    def write(self, pieces) -> None:
        try:
            with self.fs.open_output_stream(self.staging) as f:
                for piece in pieces:
                    f.write(piece)
                    self.size += len(piece)
        except BaseException:
            self.discard()
            raise

    def discard(self) -> None:
        try:
            self.fs.delete_file(self.staging)
        except Exception:
            pass

    def publish(self) -> None:
        """Move the file onto its target name, replacing an earlier attempt's file."""
        import pyarrow.fs as pafs

        if self.fs.get_file_info(self.target).type != pafs.FileType.NotFound:  # a rename does not replace everywhere
            self.fs.delete_file(self.target)
        self.fs.move(self.staging, self.target)


def write_file(path: str, pieces) -> int:
    """Write an iterable of byte pieces as one whole file from a task; returns its size.

    The bytes are staged and moved onto the target name at the end; a failure removes the staged
    file. So a retried or speculative attempt never leaves a partial or second file under the
    target name.
    """
    staged = StagedFile(path)
    staged.write(pieces)
    staged.publish()
    return staged.size
