"""Land CSV members into the partitioned landing tree.

One file per member (``sources/landing.py``). Every member is landed in the same way: a task
streams it in pieces, checked against the charset and re-encoded as UTF-8, into a hidden
staging file that is moved onto the member's fixed name at the end. So no member is ever held
whole, and a retried attempt replaces its own file. A member that is not valid in its charset,
or whose archive is damaged, is not landed and is a row with ``error`` in the report; any other
failure (storage, network) raises, and Spark tries the task again.

A CSV file whose cells may hold line ends (``multi_line``) is parsed by one task, however big. So
such a member above ``PART_BYTES`` is landed as several files, cut at record ends while it is
streamed (``sources/records.py``), each with the header: ``<member>``, ``<member>@00001``, ... They
are staged first; the file of the plain name is moved last, so a member counts as landed only
when all of its parts are there, and cuts depend on the bytes alone, so a retry makes the same files.

The landing key is (dataset, year, month, archive, member): equal member names of two archives
are two files. A member already landed for its key is skipped (anti join against the manifest),
so a re-fetched archive never doubles its rows in the stream, which tracks files by name.
"""

from __future__ import annotations

import zipfile
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import scratch_dir, ship_package
from quayside.sources.archives import NO_ARCHIVE, READ_CHUNK_BYTES, READ_CHUNK_MEMBERS, _digest_files
from quayside.sources.landing import KEYS, keys_of_path, landing_manifest, part_path
from quayside.sources.records import PartStream

PIECE_BYTES = 8 << 20
# A member that must be parsed whole is landed in parts of about this size.
PART_BYTES = 128 << 20
REPORT = "dataset string, year int, month int, archive string, member string, landed_bytes long, error string"
_AS_TEXT = "dataset string, year string, month string, archive string, member string, landed_bytes long, error string"

Partitions = list[tuple[str | None, int | None, int | None]] | None


def _keyed(df: DataFrame, default_archive) -> DataFrame:
    """``df`` with all key columns; an empty dataset or archive is the default partition, NULL."""
    if "archive" not in df.columns:
        df = df.withColumn("archive", default_archive)
    return df.withColumns({"dataset": F.nullif("dataset", F.lit("")), "archive": F.nullif("archive", F.lit(""))})


def members_to_land(members: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows of ``members`` (with the key columns) whose key is not in the manifest. Both sides
    are metadata; Spark picks the join by their sizes."""
    landed = manifest.where(F.col("part") == 0).select(*KEYS).distinct()
    return members.join(landed, [members[k].eqNullSafe(landed[k]) for k in KEYS], "left_anti")


def _text_keys(df: DataFrame, *more: str) -> DataFrame:
    """Keys as strings (pandas would turn nullable ints into floats)."""
    return df.select(*more, *[F.col(k).cast("string").alias(k) for k in KEYS])


def _pieces(read, charset: str):
    """The bytes of ``read`` as UTF-8, ended by one newline; raises on bytes invalid in ``charset``."""
    import codecs

    utf8 = charset.upper().replace("-", "") == "UTF8"
    decoder = codecs.getincrementaldecoder(charset)()
    while piece := read(PIECE_BYTES):
        text = decoder.decode(piece)
        yield piece if utf8 else text.encode("utf-8")
    tail = decoder.decode(b"", final=True)
    if tail and not utf8:
        yield tail.encode("utf-8")
    yield b"\n"


def _target(root: str, keys: tuple) -> str:
    from quayside.sources.landing import member_path

    dataset, year, month, archive, member = keys
    return member_path(root, dataset, year and int(year), month and int(month), archive, member)


def _write_member(path: str, pieces, part_bytes: int | None) -> int:
    """Land one member; returns the bytes of its files."""
    from quayside.streaming.fsutil import StagedFile, write_file

    if part_bytes is None:
        return write_file(path, pieces)
    stream, staged = PartStream(pieces, part_bytes), []
    try:
        while stream.more:
            staged.append(StagedFile(part_path(path, len(staged))))
            staged[-1].write(stream.part())
        for file in reversed(staged):  # the plain name last
            file.publish()
    except BaseException:
        for file in staged:
            file.discard()
        raise
    return sum(f.size for f in staged)


def _archive_task(root: str, charset: str, part_bytes: int | None):
    def run(batches):
        import pandas as pd

        from quayside.sources.archives import _open_seekable

        for pdf in batches:
            pdf = pdf.astype(object).where(pdf.notna(), None)
            out = []
            for path, group in pdf.groupby("archive_path", sort=False):
                rows, begin = list(zip(*[group[k] for k in KEYS])), len(out)
                try:
                    with _open_seekable(path) as raw, zipfile.ZipFile(raw) as zf:
                        for keys in rows:
                            try:
                                info = zf.getinfo(keys[-1])
                                with zf.open(info) as src:
                                    size = None if part_bytes is None or info.file_size <= part_bytes else part_bytes
                                    out.append((*keys, _write_member(_target(root, keys), _pieces(src.read, charset), size), None))
                            except (UnicodeDecodeError, zipfile.BadZipFile, zlib.error, KeyError, EOFError) as e:
                                out.append((*keys, None, f"{type(e).__name__}: {e}"))
                except NO_ARCHIVE as e:  # replaced since it was listed
                    out.extend((*keys, None, f"{type(e).__name__}: {e}") for keys in rows[len(out) - begin:])
            yield pd.DataFrame(out, columns=[*KEYS, "landed_bytes", "error"])

    return run


def _text_task(root: str):
    def run(batches):
        import io

        import pandas as pd

        from quayside.streaming.fsutil import write_file

        for pdf in batches:
            pdf = pdf.astype(object).where(pdf.notna(), None)
            out = [(*keys, write_file(_target(root, keys), _pieces(io.BytesIO(text.encode()).read, "utf-8")), None)
                   for text, *keys in pdf[["text", *KEYS]].itertuples(index=False)]
            yield pd.DataFrame(out, columns=[*KEYS, "landed_bytes", "error"])

    return run


def _report(spark: SparkSession, landed: DataFrame) -> DataFrame:
    """Run the landing once: its report, written and read again."""
    path = scratch_dir(spark, "landing-report")
    landed.select(*[F.col(k).cast("int" if k in ("year", "month") else "string").alias(k) for k in KEYS],
                  "landed_bytes", "error").write.parquet(path)
    return spark.read.schema(REPORT).parquet(path)


def one_per_key(listed: DataFrame) -> DataFrame:
    """One listing row per landing key: of archives that share a key, the greatest path."""
    rest = [c for c in listed.columns if c not in KEYS]
    pick = F.max_by(F.struct(*rest), F.col("archive_path"))
    return listed.groupBy(*KEYS).agg(pick.alias("_pick")).select(*KEYS, *[F.col(f"_pick.{c}").alias(c) for c in rest])


def landing_tasks(spark: SparkSession, todo: DataFrame, root: str, charset: str = "UTF-8",
                  part_bytes: int | None = None) -> DataFrame:
    """The landing of ``todo`` (archive_path, size_bytes and keys), spread over tasks of about
    ``READ_CHUNK_BYTES`` or ``READ_CHUNK_MEMBERS``. Only these rows cross an exchange."""
    ship_package(spark)
    size = todo.agg(F.count("*").alias("n"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes")).first()
    at_once = spark.sparkContext.defaultParallelism
    tasks = max(1, -(-size.n // READ_CHUNK_MEMBERS), -(-size.bytes // READ_CHUNK_BYTES), min(size.n, at_once))
    # An archive's members are dealt by hash in groups of so many or so many bytes. (Ranges would be
    # found from a sample that the driver collects, which for tasks of few rows is most of the listing.)
    members, size_bytes = min(READ_CHUNK_MEMBERS, -(-size.n // at_once) or 1), min(READ_CHUNK_BYTES, -(-size.bytes // at_once) or 1)
    groups = F.greatest(F.ceil(F.count("*") / members), F.ceil(F.coalesce(F.sum("size_bytes"), F.lit(0)) / size_bytes))
    grouped = todo.join(todo.groupBy("archive_path").agg(groups.alias("_groups")), "archive_path")
    grouped = grouped.withColumn("_group", F.pmod(F.xxhash64("member"), F.col("_groups")))
    spread = _text_keys(grouped, "archive_path", "_group").repartition(tasks, "archive_path", "_group").drop("_group")
    return spread.mapInPandas(_archive_task(root, charset, part_bytes), _AS_TEXT)


def land_archive_members(spark: SparkSession, listed: DataFrame, root: str, partitions: Partitions = None,
                         charset: str = "UTF-8", multi_line: bool = False, part_bytes: int = PART_BYTES) -> DataFrame:
    """Land members straight from an archive listing; returns the report (keys, landed_bytes,
    error) of the members not landed before. With ``multi_line`` members above ``part_bytes`` are
    landed in parts.

    ``listed``: (archive_path, member, dataset, year, month), and size_bytes and archive (the
    archive's key; its base name by default) if known. The already-landed check runs on this
    metadata, so a re-fetched archive costs a listing, not a read of its bytes.
    """
    listed = _keyed(listed, F.regexp_extract("archive_path", r"[^/]*$", 0))
    if "size_bytes" not in listed.columns:
        listed = listed.withColumn("size_bytes", F.lit(None).cast("long"))
    todo = members_to_land(one_per_key(listed.select("archive_path", "size_bytes", *KEYS)),
                           landing_manifest(spark, root, partitions))
    path = scratch_dir(spark, "landing-todo")
    todo.write.parquet(path)
    return _report(spark, landing_tasks(spark, spark.read.schema(todo.schema).parquet(path), root, charset,
                                        part_bytes if multi_line else None))


def land_members(spark: SparkSession, members: DataFrame, root: str, skip_landed: bool = True,
                 partitions: Partitions = None) -> DataFrame:
    """Land decoded rows (keys without ``archive`` or with it, and ``text``); rows with NULL text,
    i.e. undecodable, are not landed. Returns the report."""
    ship_package(spark)
    todo = _keyed(members, F.lit(None).cast("string")).where(F.col("text").isNotNull()).select(*KEYS, "text")
    if skip_landed:  # listed before anything is landed, and only once
        path = scratch_dir(spark, "landing-before")
        before = landing_manifest(spark, root, partitions)
        before.write.parquet(path)
        todo = members_to_land(todo, spark.read.schema(before.schema).parquet(path))
    return _report(spark, _text_keys(todo, "text").mapInPandas(_text_task(root), _AS_TEXT))


def landed_keys(spark: SparkSession, root: str, partitions: Partitions = None) -> DataFrame:
    """(dataset, year, month, archive, member, landed_bytes) of landed members (optionally of
    the given partition folders only); a member in parts has the bytes of all its files."""
    files = landing_manifest(spark, root, partitions).groupBy(*KEYS)
    whole = files.agg(F.sum("length").alias("landed_bytes"), F.min("part").alias("_part")).where(F.col("_part") == 0)
    return whole.select(*KEYS, "landed_bytes")


def changed_members(spark: SparkSession, members: DataFrame, root: str, partitions: Partitions) -> DataFrame:
    """Members already landed whose new ``text`` differs (MD5) from the landed file.

    Landing skips such members (their earlier file was, or will be, loaded once);
    this reports them. It reads the landed files of the given partition folders, but for members
    landed in parts, which are not compared.
    """
    in_parts = landing_manifest(spark, root, partitions).where(F.col("part") > 0).select(*KEYS).distinct()
    files = landing_manifest(spark, root, partitions).where(F.col("part") == 0)
    files = files.join(in_parts, [files[k].eqNullSafe(in_parts[k]) for k in KEYS], "left_anti")
    hashed = files.select("path", "length", "modificationTime").mapInArrow(_digest_files, "path string, length long, modificationTime timestamp, md5 string")
    landed = hashed.select(*keys_of_path()[:-1], F.col("md5").alias("landed_md5"))
    members = _keyed(members, F.lit(None).cast("string"))
    # Landing ends each member with one newline.
    new = members.where(F.col("text").isNotNull()).select(
        *KEYS, F.md5(F.concat(F.col("text"), F.lit("\n"))).alias("new_md5"))
    cond = [new[k].eqNullSafe(landed[k]) for k in KEYS]
    return (new.join(landed, cond, "inner").where(F.col("new_md5") != F.col("landed_md5"))
            .select(*[new[k] for k in KEYS], "landed_md5", "new_md5"))
