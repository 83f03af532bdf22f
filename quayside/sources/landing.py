"""The landing tree: ``dataset=D/year=Y/month=MM/archive=A/<member>``, one file per member.

Folder values are escaped as Hive does, NULL and '' being the default partition; the file
name is the whole member path, percent-encoded; of a member landed in parts, later parts add
``@00001`` and so on (an encoded name holds no ``@``). The tree is listed by tasks, folder by folder, so
no listing passes through the driver; the keys are parsed from the path.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType

from quayside.session import ship_package
from quayside.streaming import fsutil

KEYS = ["dataset", "year", "month", "archive", "member"]

MANIFEST_SCHEMA = StructType([
    StructField("path", StringType()),
    StructField("modificationTime", TimestampType()),
    StructField("length", LongType()),
    StructField("dataset", StringType()),
    StructField("year", IntegerType()),
    StructField("month", IntegerType()),
    StructField("archive", StringType()),
    StructField("member", StringType()),
    StructField("part", IntegerType()),
])

HIVE_DEFAULT = "__HIVE_DEFAULT_PARTITION__"
# Characters Hive escapes in a partition folder name (as %XX).
HIVE_ESCAPED = '"#%\'*/:=?\\\x7f{[]^'


def escape_partition_value(value: str | None) -> str:
    if not value:
        return HIVE_DEFAULT
    return "".join(f"%{ord(c):02X}" if (c in HIVE_ESCAPED or ord(c) < 0x20) else c for c in value)


def member_file(member: str) -> str:
    """The member path as one visible file name (names with a leading '.' or '_' are hidden)."""
    name = quote(member, safe="")
    return f"%{ord(name[0]):02X}{name[1:]}" if name[:1] in (".", "_") else name


def partition_folder(root: str, dataset: str | None, year: int | None, month: int | None) -> str:
    y = HIVE_DEFAULT if year is None else str(year)
    m = HIVE_DEFAULT if month is None else f"{month:02d}"
    return f"{root.rstrip('/')}/dataset={escape_partition_value(dataset)}/year={y}/month={m}"


def member_path(root: str, dataset: str | None, year: int | None, month: int | None, archive: str | None,
                member: str) -> str:
    return f"{partition_folder(root, dataset, year, month)}/archive={escape_partition_value(archive)}/{member_file(member)}"


def part_path(path: str, part: int) -> str:
    """The file of a member's part; part 0 has the member's own name."""
    return path if part == 0 else f"{path}@{part:05d}"


def keys_of_path() -> list[Column]:
    pattern = r"/dataset=([^/]*)/year=([^/]*)/month=([^/]*)/archive=([^/]*)/([^/@]*)(?:@[0-9]+)?$"

    def value(k: int) -> Column:
        raw = F.regexp_extract("path", pattern, k)
        return F.when(raw != HIVE_DEFAULT, F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))))

    part = F.coalesce(F.nullif(F.regexp_extract("path", "@([0-9]+)$", 1), F.lit("")).cast("int"), F.lit(0))
    return [*(value(k + 1).cast(MANIFEST_SCHEMA[n].dataType).alias(n) for k, n in enumerate(KEYS)), part.alias("part")]


def _listed(folders: DataFrame, depth: int, files: bool) -> DataFrame:
    """Entries below ``folders``, which are dealt over the tasks that run at once."""
    spread = folders.repartition(2 * folders.sparkSession.sparkContext.defaultParallelism, "path")
    return spread.mapInArrow(fsutil.list_below(depth, not files), "path string, length long, modified long" if files else "path string")


def landing_manifest(spark: SparkSession, root: str,
                     partitions: list[tuple[str | None, int | None, int | None]] | None = None) -> DataFrame:
    """path, modificationTime, length, dataset, year, month, archive, member, part of landed files.

    Listed anew whenever it is computed, a task for each share of the archives' folders. With ``partitions``
    only those (dataset, year, month) folders are listed, so a run's check costs what the run touches, not
    the whole history of the tree.
    """
    ship_package(spark)
    if partitions is None:
        years = _listed(spark.createDataFrame([(root,)], "path string"), 2, False)
        archives = _listed(years, 2, False)
    else:
        months = sorted({partition_folder(root, d, y, m) for d, y, m in partitions})
        archives = _listed(spark.createDataFrame([(m,) for m in months], "path string"), 1, False)
    files = _listed(archives, 1, True)
    return files.select("path", F.timestamp_micros("modified").alias("modificationTime"), "length", *keys_of_path())


def dataset_path(root: str, dataset: str) -> str:
    """Folder a dataset's stream reads."""
    return f"{root.rstrip('/')}/dataset={dataset}"
