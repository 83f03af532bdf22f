"""Runs of equal keys in range-partitioned, sorted rows.

Rows are dealt by ranges of (key, order), so that a key of very many rows spreads over several ranges, and
sorted inside them (a secondary sort). One streaming pass marks the first row of every run. Only the
first and the last run of a range can go on in another: each range reports these two, and what the
ranges report (at most two rows a range) corrects the rows of first runs by a broadcast join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import written


def changes(col: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before (null equals null)."""
    a, b = col.slice(1), col.slice(0, max(len(col) - 1, 0))
    differs = pc.fill_null(pc.not_equal(a, b), False)
    return np.asarray(pc.or_(differs, pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False), dtype=bool)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def mark_runs(rows: DataFrame, value: str, *order: Column, name: str) -> DataFrame:
    """``rows`` (with the 128-bit key ``k1``, ``k2``) plus ``_lead``, the ``value`` of the first row of the
    key, and ``_first``, whether the row is that one. Rows of a key come in ``order``, which starts
    with ``value`` and tells apart all rows that are not interchangeable."""
    spark, schema = rows.sparkSession, rows.schema
    out = T.StructType([*schema.fields, T.StructField("_lead", schema[value].dataType), T.StructField("_first", T.BooleanType()), T.StructField("_edge", T.BooleanType()), T.StructField("_range", T.IntegerType())])
    names = schema.names

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId()
        key, lead, first_run, kinds = None, None, None, None
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            kinds = [b.schema.field(c).type for c in names]
            k = np.stack([np.asarray(b.column("k1")), np.asarray(b.column("k2"))], 1)
            new = np.append(key != tuple(k[0]), np.any(k[1:] != k[:-1], axis=1))
            pool = pa.concat_arrays([pa.array([lead], b.column(value).type), b.column(value)])
            begin = np.maximum.accumulate(np.where(new, np.arange(1, n + 1), 0))  # 0: the run of the batch before
            leads = pool.take(pa.array(begin))
            if first_run is None:
                first_run = (tuple(k[0]), leads[0].as_py())
            edge = (k == np.array(first_run[0])).all(1)
            yield pa.record_batch([*(b.column(c) for c in names), leads, pa.array(new), pa.array(edge), pa.array(np.full(n, at), pa.int32())], [*names, "_lead", "_first", "_edge", "_range"])
            key, lead = tuple(k[-1]), leads[-1].as_py()
        if key is not None:  # what this range reports: rows without ``_edge``
            ends = [first_run] if first_run[0] == key else [first_run, (key, lead)]
            own = {"k1": [e[0][0] for e in ends], "k2": [e[0][1] for e in ends]}
            cols = [pa.array(own.get(c, [None] * len(ends)), t) for c, t in zip(names, kinds, strict=True)]
            lead_type = kinds[names.index(value)]
            yield pa.record_batch([*cols, pa.array([e[1] for e in ends], lead_type), pa.nulls(len(ends), pa.bool_()), pa.nulls(len(ends), pa.bool_()), pa.array([at] * len(ends), pa.int32())], [*names, "_lead", "_first", "_edge", "_range"])

    dealt = rows.repartitionByRange(shuffle_partitions(rows), "k1", "k2", *order).sortWithinPartitions("k1", "k2", *order)
    marked = written(spark, dealt.mapInArrow(stream, out), name)
    heads = marked.filter(F.col("_edge").isNull()).groupBy("k1", "k2").agg(F.min(F.struct("_range", "_lead")).alias("_head"), F.count("*").alias("_n"))
    heads = heads.filter(F.col("_n") > 1).select("k1", "k2", "_head")
    inner = marked.filter(~F.col("_edge")).select(*names, "_lead", "_first")
    outer = marked.filter("_edge").join(F.broadcast(heads), ["k1", "k2"], "left")
    before = F.coalesce(F.col("_head._range") < F.col("_range"), F.lit(False))
    outer = outer.withColumns({"_lead": F.when(before, F.col("_head._lead")).otherwise(F.col("_lead")), "_first": F.col("_first") & ~before})
    return inner.unionByName(outer.select(*names, "_lead", "_first"))
