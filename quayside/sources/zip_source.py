"""Members of zip archives as a Spark data source.

``zip_members`` registers the source and reads with it; then ``spark.read.format("zip_members").load(folder)``
works too. A row per member. Options:

- ``path``: a folder (searched below) or an archive; ``glob``: names of archives, ``*.zip`` by default;
- ``content`` (false): a column with the member's bytes; ``digest`` (false): a column with their MD5, hashed in
  pieces, so a member of any size; a content above 2 GB is an error row;
- ``directories`` (false): folder entries too;
- ``chunkBytes`` (128 MB): bytes of archives per input partition.

An input partition is one read chunk: small archives are packed together, a big one is cut into byte
ranges, and a range has the members whose header begins in it. So nothing but names and sizes of archives is
looked at while planning. Filters on the member columns can be pushed down (``=``, ``<=>``, ``IN``, comparisons, null
tests, ``LIKE`` of prefix, suffix and infix, and ``NOT``) and decided on the archive's directory, before a member is
opened. ``extension`` is the part of the member name after its last dot, in lower case, so
``extension = 'csv'`` is the case-insensitive suffix test.

An archive that cannot be read gives one row with ``error`` and no member, a damaged member a row with
``error`` and neither content nor digest. Storage errors raise, and Spark tries the task again.
"""

from __future__ import annotations

import fnmatch
import hashlib
import os
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType

from quayside.sources.archives import MEMBER_BATCH_BYTES, MEMBER_BATCH_ROWS, NO_ARCHIVE, READ_CHUNK_BYTES, _open_seekable, hash_pieces
from quayside.streaming import fsutil

FORMAT = "zip_members"
#: Columns known from an archive's directory: filters on them are pushed down.
LISTED = [
    StructField("archive_path", StringType()),
    StructField("archive_bytes", LongType()),
    StructField("member", StringType()),
    StructField("basename", StringType()),
    StructField("extension", StringType()),
    StructField("is_dir", BooleanType()),
    StructField("size_bytes", LongType()),
    StructField("compressed_bytes", LongType()),
]
LARGEST_CONTENT = (1 << 31) - 1
DAMAGED = (zipfile.BadZipFile, zlib.error, EOFError, RuntimeError, NotImplementedError)


# ---------------------------------------------------------------- pushed filters

_COMPARE = {
    ds.GreaterThan: lambda a, b: a > b, ds.GreaterThanOrEqual: lambda a, b: a >= b,
    ds.LessThan: lambda a, b: a < b, ds.LessThanOrEqual: lambda a, b: a <= b,
    ds.EqualTo: lambda a, b: a == b, ds.StringStartsWith: lambda a, b: a.startswith(b),
    ds.StringEndsWith: lambda a, b: a.endswith(b), ds.StringContains: lambda a, b: b in a,
    ds.In: lambda a, b: a in b,
}


def supported(f: ds.Filter) -> bool:
    """Whether the reader decides ``f`` exactly: on one column of the directory."""
    if isinstance(f, ds.Not):
        return supported(f.child)
    known = isinstance(f, (*_COMPARE, ds.EqualNullSafe, ds.IsNull, ds.IsNotNull))
    if isinstance(f, ds.In) and any(v is None for v in f.value):
        return False
    return known and len(f.attribute) == 1 and f.attribute[0] in {c.name for c in LISTED}


def holds(f: ds.Filter, row: dict) -> bool | None:
    """``f`` on a member's directory columns, None for unknown (a comparison with null), as in SQL."""
    if isinstance(f, ds.Not):
        child = holds(f.child, row)
        return None if child is None else not child
    value = row[f.attribute[0]]
    if isinstance(f, ds.IsNull):
        return value is None
    if isinstance(f, ds.IsNotNull):
        return value is not None
    if isinstance(f, ds.EqualNullSafe):
        return value == f.value
    if value is None or f.value is None:
        return None
    return _COMPARE[type(f)](value, f.value)


# ---------------------------------------------------------------- planning


@dataclass
class Chunk(ds.InputPartition):
    """(archive, its bytes, first byte, end byte) of the parts read by one task."""

    parts: list[tuple[str, int, int, int]]


def find_archives(path: str, glob: str) -> list[tuple[str, int]]:
    """(path, bytes) of the visible files below ``path`` whose name matches, by path."""
    import pyarrow.fs as pafs

    m = fsutil._URI.match(path)
    if m is None or m.group(1).lower() == "file":
        fs, target, prefix = pafs.LocalFileSystem(), os.path.abspath(path if m is None else m.group(3)), "file:"
    else:
        scheme, authority, rest = m.group(1).lower(), (m.group(2) or "")[2:], m.group(3)
        fs, _ = pafs.FileSystem.from_uri(f"{fsutil._ARROW_SCHEME.get(scheme, scheme)}://{authority}/")
        bucket = scheme in ("s3a", "s3n", "s3", "gs", "gcs")
        target, prefix = (f"{authority}{rest}", f"{scheme}://") if bucket else (rest, f"{scheme}://{authority}")
    info = fs.get_file_info(target)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    below = len(target.rstrip("/")) + 1
    files = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(target, recursive=True))
    return sorted((prefix + f.path, f.size) for f in files if f.type == pafs.FileType.File and (
        f is info or (fnmatch.fnmatchcase(f.base_name, glob) and all(map(fsutil._visible, f.path[below:].split("/"))))))


def chunks(archives: list[tuple[str, int]], size: int) -> list[Chunk]:
    """Read chunks of about ``size`` bytes."""
    out: list[Chunk] = []
    held, parts = 0, []
    for path, total in archives:
        cuts = [*range(0, max(total, 1), size), max(total, 1)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if parts and held + b - a > size:
                out.append(Chunk(parts))
                held, parts = 0, []
            parts.append((path, total, a, b))
            held += b - a
    return [*out, Chunk(parts)] if parts else out


# ---------------------------------------------------------------- reading


class ZipReader(ds.DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.options, self.names = {k.lower(): v for k, v in options.items()}, schema.names
        self.filters: list[ds.Filter] = []

    def _flag(self, name: str) -> bool:
        return str(self.options.get(name, "false")).lower() == "true"

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        for f in filters:
            if supported(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> Sequence[ds.InputPartition]:
        found = find_archives(self.options["path"], self.options.get("glob", "*.zip"))
        return chunks(found, int(self.options.get("chunkbytes", READ_CHUNK_BYTES))) or [Chunk([])]

    def _members(self, path: str, total: int, first: int, end: int) -> Iterator[dict]:
        content, digest, folders = self._flag("content"), self._flag("digest"), self._flag("directories")
        empty = dict.fromkeys([c.name for c in LISTED]) | {"archive_path": path, "archive_bytes": total}
        wanted = lambda row: all(holds(f, row) for f in self.filters)
        try:
            with _open_seekable(path) as raw, zipfile.ZipFile(raw) as zf:
                for info in zf.infolist():
                    folder = info.is_dir()
                    if not first <= info.header_offset < end or (folder and not folders):
                        continue
                    base = os.path.basename(info.filename.rstrip("/"))
                    row = empty | {
                        "member": info.filename, "basename": base, "is_dir": folder, "size_bytes": info.file_size,
                        "extension": base.rpartition(".")[2].lower() if "." in base else "", "compressed_bytes": info.compress_size}
                    if not wanted(row):
                        continue
                    if folder or not (content or digest):
                        yield row
                        continue
                    try:
                        if content and info.file_size > LARGEST_CONTENT:
                            raise ValueError(f"{info.file_size} bytes do not fit in a row")
                        kept: list[bytes] = []
                        with zf.open(info) as src:
                            md5 = hash_pieces(src.read, hashlib.md5(), kept.append if content else None)
                        yield row | {"content": b"".join(kept) if content else None, "md5": md5}
                    except (*DAMAGED, ValueError) as e:
                        yield row | {"error": f"{type(e).__name__}: {e}"}
        except NO_ARCHIVE as e:
            if first == 0 and wanted(empty):
                yield empty | {"error": f"{type(e).__name__}: {e}"}

    def read(self, partition: Chunk) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0

        def batch() -> pa.RecordBatch:
            return pa.record_batch([pa.array([r.get(c) for r in rows], _ARROW[c]) for c in self.names], self.names)

        for part in partition.parts:
            for row in self._members(*part):
                rows.append(row)
                held += len(row.get("content") or b"")
                if held >= MEMBER_BATCH_BYTES or len(rows) >= MEMBER_BATCH_ROWS:
                    yield batch()
                    rows, held = [], 0
        if rows:
            yield batch()


_ARROW = {c.name: {StringType(): pa.string(), LongType(): pa.int64(), BooleanType(): pa.bool_()}[c.dataType] for c in LISTED} | {
    "content": pa.binary(), "md5": pa.string(), "error": pa.string()}


class ZipMembers(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        more = [StructField("content", BinaryType())] if str(self.options.get("content", "")).lower() == "true" else []
        more += [StructField("md5", StringType())] if str(self.options.get("digest", "")).lower() == "true" else []
        return StructType([*LISTED, *more, StructField("error", StringType())])

    def reader(self, schema: StructType) -> ds.DataSourceReader:
        return ZipReader(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    """Make the format known to ``spark``, with the setting that a reader with ``pushFilters`` needs."""
    from quayside.session import ship_package

    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ZipMembers)


def zip_members(spark: SparkSession, path: str, where: Column | str | None = None, content: bool = False, digest: bool = False,
                **options: str) -> DataFrame:
    """Members of the archives below ``path`` that meet ``where``, which is pushed down to the source.

    Spark 4.1 keeps the filters pushed last with the loaded frame, not with the query: of two queries (or two
    branches of one) that filter one frame differently, both would read by the last filter. So every call
    loads a frame of its own, and an observation above ``where`` holds back the filters of
    later steps, which Spark then applies itself. Without this helper, load anew for every filter."""
    register(spark)
    flags = {"content": str(content).lower(), "digest": str(digest).lower()}
    members = spark.read.format(FORMAT).options(**flags, **options).load(path)
    if where is not None:
        members = members.where(where)
    return members.observe(f"zip_members_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("members"))
