"""Zip archives as a Spark source.

``scan_archives``: one row per archive file (path, size, modification time, MD5), listed by
the ``binaryFile`` source and hashed in pieces.

``archive_members``: one row per member, produced on the executors by
``mapInPandas``. A task opens each archive by path (seekable, so only the central
directory and the wanted members are read), never the whole archive through the
driver. Content is read in a second phase: the (archive, member) pairs are
dealt over tasks by chunk, so one huge archive is read by many tasks in parallel,
each fetching only its own members; output batches are cut by size.
"""

from __future__ import annotations

import zipfile

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType

from quayside.functions.paths import basename
from quayside.streaming import fsutil

MEMBER_SCHEMA = StructType([
    StructField("archive_path", StringType()),
    StructField("member", StringType()),
    StructField("basename", StringType()),
    StructField("is_dir", BooleanType()),
    StructField("size_bytes", LongType()),
    StructField("compressed_bytes", LongType()),
    StructField("content", BinaryType()),
    StructField("error", StringType()),
    StructField("read_chunk", LongType()),
])

# What a file that is no (whole) zip archive raises: too short a file fails in a seek.
NO_ARCHIVE = (zipfile.BadZipFile, pa.ArrowInvalid)

# Members of one archive are read in chunks (in central-directory order) of about this
# many uncompressed bytes or this many members, whichever comes first; chunks, not
# archives, are the unit spread over tasks. Landing costs per file as much as per
# byte, so many small members are spread by count as a few big ones are by size.
READ_CHUNK_BYTES = 128 << 20
READ_CHUNK_MEMBERS = 250

# Output batches are flushed at this many bytes of member content or this many rows,
# so a listing of an archive with millions of members streams out in pieces too.
MEMBER_BATCH_BYTES = 64 << 20
MEMBER_BATCH_ROWS = 10_000


# Files and members are hashed in pieces of this many bytes.
HASH_PIECE_BYTES = 8 << 20


def hash_pieces(read, digest, keep=None) -> str:
    """Hex digest of all that ``read(n)`` returns, a piece at a time; ``keep`` gets every piece."""
    while piece := read(HASH_PIECE_BYTES):
        digest.update(piece)
        if keep is not None:
            keep(piece)
    return digest.hexdigest()


def _digest_files(batches):
    import hashlib

    for b in batches:
        md5 = []
        for path in b.column("path").to_pylist():
            with _open_seekable(path) as raw:
                md5.append(hash_pieces(raw.read, hashlib.md5()))
        yield pa.record_batch([*b.columns, pa.array(md5, pa.string())], [*b.schema.names, "md5"])


def scan_archives(spark: SparkSession, path: str, glob: str = "*.zip", with_md5: bool = True) -> DataFrame:
    """archive_path, archive (base name), size_bytes, modified, md5 (hex of the bytes).

    The scan lists files and deals them over tasks by their size, without their content; a task
    hashes its files in pieces, so an archive of any size."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime"))
    if with_md5:
        from quayside.session import ship_package

        ship_package(spark)
        files = files.mapInArrow(_digest_files, "path string, length long, modificationTime timestamp, md5 string")
    return files.select(
        F.col("path").alias("archive_path"),
        basename("path").alias("archive"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified"),
        *(["md5"] if with_md5 else []),
    )


def _open_seekable(path: str):
    fs, target, _ = fsutil.located(path)
    return fs.open_input_file(target)


def _members_of(with_content: bool, include_dirs: bool, suffix: str | None):
    def run(batches):
        import os

        import pandas as pd

        cols = [f.name for f in MEMBER_SCHEMA.fields]
        rows, held = [], 0
        for pdf in batches:
            for path in pdf["archive_path"]:
                try:
                    with _open_seekable(path) as raw, zipfile.ZipFile(raw) as zf:
                        chunk, chunk_bytes, chunk_members = 0, 0, 0
                        for info in zf.infolist():
                            is_dir = info.is_dir()
                            if chunk_members and (chunk_bytes >= READ_CHUNK_BYTES
                                                  or chunk_members >= READ_CHUNK_MEMBERS):
                                chunk, chunk_bytes, chunk_members = chunk + 1, 0, 0
                            if not is_dir:
                                chunk_bytes += info.file_size
                                chunk_members += 1
                            if is_dir and not include_dirs:
                                continue
                            want = with_content and not is_dir and (
                                suffix is None or info.filename.lower().endswith(suffix))
                            content = zf.read(info.filename) if want else None
                            rows.append((path, info.filename, os.path.basename(info.filename.rstrip("/")) if is_dir
                                         else os.path.basename(info.filename), is_dir, info.file_size,
                                         info.compress_size, content, None, chunk))
                            held += len(content) if content else 0
                            if held >= MEMBER_BATCH_BYTES or len(rows) >= MEMBER_BATCH_ROWS:
                                yield pd.DataFrame(rows, columns=cols)
                                rows, held = [], 0
                except NO_ARCHIVE as e:  # no archive: one row with the error; storage errors raise
                    rows.append((path, None, None, None, None, None, None, f"{type(e).__name__}: {e}", None))
        if rows:
            yield pd.DataFrame(rows, columns=cols)

    return run


def _read_members(extra: tuple[str, ...] = ()):
    """Task body: read the listed members of each archive; ``extra`` columns (strings)
    are carried through unchanged."""
    def run(batches):
        import os

        import pandas as pd

        cols = [f.name for f in MEMBER_SCHEMA.fields] + list(extra)
        rows, held = [], 0
        for pdf in batches:
            for path, group in pdf.groupby("archive_path", sort=False):
                carried = list(zip(*[group[c].tolist() for c in extra])) if extra else [()] * len(group)
                sent: set[str] = set()
                try:
                    with _open_seekable(path) as raw, zipfile.ZipFile(raw) as zf:
                        for name, chunk, keys in zip(group["member"], group["read_chunk"], carried):
                            info = zf.getinfo(name)
                            content = zf.read(info)
                            rows.append((path, name, os.path.basename(name), False, info.file_size,
                                         info.compress_size, content, None, int(chunk), *keys))
                            sent.add(name)
                            held += len(content)
                            if held >= MEMBER_BATCH_BYTES or len(rows) >= MEMBER_BATCH_ROWS:
                                yield pd.DataFrame(rows, columns=cols)
                                rows, held = [], 0
                except NO_ARCHIVE as e:  # damaged or replaced since listing
                    for name, chunk, keys in zip(group["member"], group["read_chunk"], carried):
                        if name in sent:
                            continue
                        rows.append((path, name, os.path.basename(name), False, None, None, None,
                                     f"{type(e).__name__}: {e}", int(chunk), *keys))
        if rows:
            yield pd.DataFrame(rows, columns=cols)

    return run


def read_members(listed: DataFrame, read_partitions: int | None = None) -> DataFrame:
    """Content of listed members: rows with ``archive_path``, ``member``, ``read_chunk``
    (from ``archive_members``) and any further columns, which are carried through, but for those
    that the result has itself (``size_bytes``, used for the number of tasks).

    Only these metadata rows cross the shuffle; the bytes are read in the task that
    uses them. A read chunk stays in one task, so an archive is opened once per chunk,
    and a huge archive is read by many tasks.
    """
    from quayside.session import ship_package

    ship_package(listed.sparkSession)
    core = ["archive_path", "member", "read_chunk"]
    extra = [c for c in listed.columns if c not in core and c not in MEMBER_SCHEMA.fieldNames()]
    types = {c: listed.schema[c].dataType for c in extra}
    n = read_partitions
    if n is None:  # as landing does: by members and bytes
        bytes_of = F.sum("size_bytes") if "size_bytes" in listed.columns else F.lit(0)
        size = listed.agg(F.count("*").alias("n"), F.coalesce(bytes_of, F.lit(0)).alias("bytes")).first()
        n = max(listed.sparkSession.sparkContext.defaultParallelism, -(-size.n // READ_CHUNK_MEMBERS), -(-size.bytes // READ_CHUNK_BYTES))
    # Chunks are about equal and dealt by hash; each is one key, so it stays in one task. (Ranges
    # would be found from a sample that the driver collects.)
    spread = (listed.select(*core, *[F.col(c).cast("string").alias(c) for c in extra])
              .repartition(n, "archive_path", "read_chunk"))
    schema = StructType(MEMBER_SCHEMA.fields + [StructField(c, StringType()) for c in extra])
    content = spread.mapInPandas(_read_members(tuple(extra)), schema)
    # Carried columns travel as strings (pandas would turn nullable ints into floats).
    return content.select(*MEMBER_SCHEMA.fieldNames(), *[F.col(c).cast(types[c]).alias(c) for c in extra])


def archive_members(archives: DataFrame, with_content: bool = False, include_dirs: bool = False,
                    content_suffix: str | None = ".csv", read_partitions: int | None = None) -> DataFrame:
    """Members of every archive in ``archives`` (column ``archive_path``).

    Directories are skipped unless ``include_dirs``. Content is read only when
    ``with_content`` and only for members ending in ``content_suffix`` (any case;
    None for all). An archive that cannot be opened gives one row with ``error``
    set and NULL member. ``read_partitions`` (default: twice the default
    parallelism) is the number of tasks content reads are spread over.
    """
    from quayside.session import ship_package

    ship_package(archives.sparkSession)
    listing = archives.select("archive_path").mapInPandas(_members_of(False, include_dirs, None), MEMBER_SCHEMA)
    if not with_content:
        return listing
    wanted = F.col("error").isNull() & ~F.col("is_dir")
    if content_suffix is not None:
        wanted = wanted & F.lower(F.col("member")).endswith(content_suffix.lower())
    content = read_members(listing.where(wanted).select("archive_path", "member", "read_chunk", "size_bytes"), read_partitions)
    return listing.where(~wanted | wanted.isNull()).unionByName(content)


def is_csv(member: Column | str = "member") -> Column:
    """Case-insensitive '.csv' suffix of the member name."""
    m = F.col(member) if isinstance(member, str) else member
    return F.lower(m).endswith(".csv")


def _strict_decoder(charset: str):
    @F.pandas_udf("string")
    def decode(content: pd.Series) -> pd.Series:
        def one(b):
            try:
                return None if b is None else bytes(b).decode(charset)
            except UnicodeDecodeError:
                return None

        return content.map(one)

    return decode


def decode_members(members: DataFrame, charset: str = "UTF-8") -> DataFrame:
    """Adds ``is_valid`` and ``text``: the content decoded, NULL when it is not valid
    in ``charset`` (UTF-8 is checked by Spark, other charsets by Python's strict decoder)."""
    raw = F.col("content").cast("string")
    if charset.upper().replace("-", "") == "UTF8":
        valid = F.is_valid_utf8(raw)
        text = F.when(valid, raw)
    else:
        text = _strict_decoder(charset)("content")
        valid = F.when(F.col("content").isNotNull(), text.isNotNull())
    return members.withColumns({"is_valid": valid, "text": text})
