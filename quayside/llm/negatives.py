"""Hard-negative mining over Hilbert-ordered vector blocks with zone maps.

1. Vectors, one per id, get a key on a Hilbert curve through the ``CURVE_DIMS`` dimensions of greatest variance
   (statistics of all rows), are dealt by ranges of (length, label, key, id) and cut into blocks. A
   block is a Parquet row: ids, labels, vectors and its zone map, the least and greatest value of every dimension
   and of the label. A label of very many rows spreads over ranges. Blocks also give their anchors a
   floor, the ``POSITIVES``-th best score inside their own block.
2. Anchors form groups in the order of the curve. For an anchor a and a zone [lo, hi], interval arithmetic bounds
   every score: a+ . lo + a- . hi <= a . x <= a+ . hi + a- . lo. Zones of whole ranges (at most ``RANGES``, so
   their size is bounded) first rule out ranges; the zone maps of the rest, read without
   their vectors, then choose the blocks each group must read.
3. Positives: blocks that may reach an anchor's floor. Negatives: blocks whose bounds meet one of the anchor's
   score windows. Chosen blocks are joined to the pairs, dealt by (group, unit of blocks) and solved one after
   the other in numpy; the best of every unit are merged by rank.

Semantics: components become ``floor(256 * x)``; a score is the inner product of an anchor and another row of the
same length, exact below 2 ** 53 and held at that bound beyond it. Higher scores first, ties to the smaller
id. An anchor's positives are its first ``POSITIVES`` other rows of its label; for each, the first
``NEGATIVES`` rows of other labels with 50 p <= 100 s <= 95 p are returned (a window is empty for p < 0).
Rows with a null id, label or vector, a null or non-finite component (also once scaled), or no component take
no part. Of several rows of one id the one of least (label, vector) takes part. Other columns of the input
are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import EXACT, LARGEST, held_score, whole_vector, written
from quayside.llm.runs import shuffle_partitions

POSITIVES = 5
NEGATIVES = 3
SCALE = 256
CURVE_DIMS = 16
CURVE_BITS = 4
#: Dimensions looked at for the choice of the curve's.
STAT_DIMS = 256
BLOCK = 512
GROUP = 1_024
RANGES = 4_096
#: Numbers that the zones of all ranges may have.
ZONE_NUMBERS = 1 << 23
BLOCKS_PER_UNIT = 2_048
LEAST_UNITS = 32


# ---------------------------------------------------------------- vectors and their order


def usable(vectors: DataFrame, is_anchor: Column) -> DataFrame:
    """``vec_id, label, v, anchor``: scaled vectors that take part, one per id."""
    v, usable_vector = whole_vector("embedding", SCALE)
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable_vector)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"), F.max("anchor").alias("anchor"))
    return one.select("vec_id", F.col("r.label").alias("label"), F.col("r.v").alias("v"), "anchor")


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of whole-number points (n, dims) of ``bits`` bits a dimension, as uint64."""
    x = cells.astype(np.uint64).T.copy()
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):  # undo the curve's turns from the coarsest level on
        bit, low = one << np.uint64(b), (one << np.uint64(b)) - one
        for i in range(len(x)):
            hit = (x[i] & bit) != 0
            swap = np.where(hit, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(hit, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(b)) & one, (one << np.uint64(b)) - one, np.uint64(0))
    x ^= turn
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for row in x:
            key = (key << one) | ((row >> np.uint64(b)) & one)
    return key


def _moments(rows: DataFrame) -> dict[int, tuple[float, float]]:
    """(mean, standard deviation) of the first ``STAT_DIMS`` dimensions over all rows."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q = np.zeros(STAT_DIMS), np.zeros(STAT_DIMS), np.zeros(STAT_DIMS)
        for b in batches:
            col = b.column("v")
            at = np.arange(len(col.flatten())) - np.repeat(np.asarray(col.offsets)[:-1] - col.offsets[0].as_py(), col.value_lengths())
            x, at = np.asarray(col.flatten())[at < STAT_DIMS], at[at < STAT_DIMS]
            x = np.clip(x, -1e100, 1e100)
            n += np.bincount(at, minlength=STAT_DIMS)
            s += np.bincount(at, x, minlength=STAT_DIMS)
            q += np.bincount(at, x * x, minlength=STAT_DIMS)
        yield pa.record_batch([pa.array(np.arange(STAT_DIMS)), pa.array(n), pa.array(s), pa.array(q)], ["at", "n", "s", "q"])

    total = rows.select("v").mapInArrow(sums, "at long, n double, s double, q double").groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    return {r["at"]: (r["s"] / r["n"], math.sqrt(max(r["q"] / r["n"] - (r["s"] / r["n"]) ** 2, 0.0))) for r in total.collect() if r["n"]}


def _narrow(x: np.ndarray) -> bytes:
    """Rows of whole numbers as bytes, two a number where they fit."""
    return x.astype("<i2").tobytes() if len(x) and np.abs(x).max() < 1 << 15 else x.astype("<f8").tobytes()


def _wide(raw: bytes, n: int, d: int) -> np.ndarray:
    return np.frombuffer(raw, "<i2" if len(raw) == 2 * n * d else "<f8").reshape(n, d).astype(np.float64)


def keyed(rows: DataFrame, moments: dict[int, tuple[float, float]]) -> DataFrame:
    """``d, label, key, vec_id, anchor, raw``: the vectors as bytes with their place on the curve."""
    dims = sorted(sorted(moments, key=lambda c: (-moments[c][1], c))[:CURVE_DIMS])
    mean, spread = np.array([moments[c][0] for c in dims]), np.array([moments[c][1] or 1.0 for c in dims])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col, ids = b.column("v"), np.arange(b.num_rows)
            lengths = np.asarray(col.value_lengths())
            flat, begin = np.asarray(col.flatten()), np.concatenate([[0], np.cumsum(lengths)])
            cells = np.zeros((len(ids), len(dims)))
            for j, c in enumerate(dims):
                has = lengths > c
                cells[has, j] = (flat[begin[:-1][has] + c] - mean[j]) / spread[j]
            levels = 1 << CURVE_BITS
            key = hilbert(np.clip((cells + 2) * levels / 4, 0, levels - 1).astype(np.int64), CURVE_BITS) if len(dims) and len(ids) else np.zeros(len(ids), np.uint64)
            raw = [_narrow(flat[i:j]) for i, j in zip(begin[:-1], begin[1:], strict=True)]
            yield pa.record_batch([pa.array(lengths, pa.int32()), b.column("label"), pa.array((key ^ np.uint64(1 << 63)).view(np.int64)), b.column("vec_id"), b.column("anchor"), pa.array(raw, pa.binary())], ["d", "label", "key", "vec_id", "anchor", "raw"])

    return rows.mapInArrow(run, "d int, label long, key long, vec_id long, anchor boolean, raw binary")


# ---------------------------------------------------------------- bounds


def upper(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Greatest scores that anchors (a, d) may have in zones (z, d), rounding included."""
    out = np.maximum(anchors, 0) @ hi.T + np.minimum(anchors, 0) @ lo.T
    return held_score(out + 1e-12 * (np.abs(anchors) @ np.maximum(np.abs(lo), np.abs(hi)).T))


def lower(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return -upper(-anchors, lo, hi)


def scores(anchors: np.ndarray, x: np.ndarray) -> np.ndarray:
    return held_score(anchors @ x.T)


def window(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest score of a negative: 50 p <= 100 s <= 95 p in whole numbers."""
    p = positive.astype(np.int64)
    return (-((-p) // 2)).astype(np.float64), ((95 * p) // 100).astype(np.float64)


def best(rows: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The places of the ``k`` best entries of every row number: higher scores, then smaller ids."""
    order = np.lexsort((ids, -score, rows))
    r = rows[order]
    begin = np.flatnonzero(np.append(True, r[1:] != r[:-1])) if len(r) else np.zeros(0, np.int64)
    place = np.arange(len(r)) - np.repeat(begin, np.diff(np.append(begin, len(r))))
    return order[place < k]


class Leaders:
    """The ``k`` best (score, id) of so many rows, and what the last of them scores."""

    def __init__(self, n: int, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.rows, self.score, self.ids = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        self.n = n

    def offer(self, rows: np.ndarray, s: np.ndarray, ids: np.ndarray) -> None:
        """``s``: (len(rows), len(ids)) scores, -inf for what does not count."""
        if s.shape[1] > self.k:
            bar = np.partition(s, -self.k, axis=1)[:, -self.k]
        else:
            bar = np.full(len(s), -np.inf)
        i, j = np.nonzero((s >= np.maximum(bar, self.least[rows])[:, None]) & np.isfinite(s))
        if not len(i):
            return
        r, v, x = np.append(self.rows, rows[i]), np.append(self.score, s[i, j]), np.append(self.ids, ids[j])
        at = best(r, v, x, self.k)
        self.rows, self.score, self.ids = r[at], v[at], x[at]
        last = np.bincount(self.rows, minlength=self.n) == self.k
        worst = np.full(self.n, np.inf)
        np.minimum.at(worst, self.rows, self.score)
        self.least[last] = np.maximum(self.least[last], worst[last])


# ---------------------------------------------------------------- blocks, zones, groups

_BLOCKS = "anchor boolean, range int, block long, d int, label long, label_to long, n int, key long, vec_id long, ids binary, labels binary, lo binary, hi binary, raw binary, floor double"
_GROUP = "g long, d int, n int, ids binary, labels binary, raw binary, floors binary"


def _i8(x) -> bytes:
    return np.asarray(x, "<i8").tobytes()


def _f8(x) -> bytes:
    return np.asarray(x, "<f8").tobytes()


def blocks_of(rows: DataFrame, n_ranges: int) -> DataFrame:
    """The Parquet table of blocks (``anchor`` false) and of the anchors with their floors."""
    spark, names = rows.sparkSession, [c.split()[0] for c in _BLOCKS.split(", ")]
    order = ["d", "label", "key", "vec_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, k, held = TaskContext.get().partitionId(), 0, None  # held: columns of rows not yet in a block

        def block(d: int, label, key, ids, anchor, raw) -> pa.RecordBatch:
            nonlocal k
            n = len(ids)
            x = np.stack([_wide(r, 1, d)[0] for r in raw])
            own = np.flatnonzero(anchor)
            s = scores(x[own], x)
            s[(label[own][:, None] != label[None]) | (ids[own][:, None] == ids[None])] = -np.inf
            floor = np.partition(s, -POSITIVES, axis=1)[:, -POSITIVES] if n >= POSITIVES else np.full(len(own), -np.inf)
            number = (at << 32) + k
            k += 1
            out = [(False, at, number, d, int(label.min()), int(label.max()), n, None, None, _i8(ids), _i8(label), _f8(x.min(0)), _f8(x.max(0)), _narrow(x), None)]
            out += [(True, at, number, d, int(label[i]), int(label[i]), 1, int(key[i]), int(ids[i]), None, None, None, None, raw[i], float(f)) for i, f in zip(own, floor, strict=True)]
            return pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], _ARROW_BLOCKS)

        for b in batches:
            if not b.num_rows:
                continue
            new = [b.column("d").to_numpy(), b.column("label").to_numpy(), b.column("key").to_numpy(), b.column("vec_id").to_numpy(), b.column("anchor").to_numpy(zero_copy_only=False), np.array(b.column("raw").to_pylist() + [None], object)[:-1]]
            held = new if held is None else [np.concatenate(c) for c in zip(held, new, strict=True)]
            while len(held[0]):
                same = int(np.searchsorted(held[0], held[0][0], "right"))  # blocks hold vectors of one length
                if same < BLOCK and same == len(held[0]):
                    break
                size = min(same, BLOCK)
                yield block(int(held[0][0]), *(c[:size] for c in held[1:]))
                held = [c[size:] for c in held]
        if held is not None and len(held[0]):
            yield block(int(held[0][0]), *held[1:])

    dealt = rows.repartitionByRange(n_ranges, *order).sortWithinPartitions(*order)
    return written(spark, dealt.mapInArrow(cut, _BLOCKS), "vector-blocks")


_ARROW_BLOCKS = pa.schema([("anchor", pa.bool_()), ("range", pa.int32()), ("block", pa.int64()), ("d", pa.int32()), ("label", pa.int64()), ("label_to", pa.int64()), ("n", pa.int32()), ("key", pa.int64()), ("vec_id", pa.int64()), ("ids", pa.binary()), ("labels", pa.binary()), ("lo", pa.binary()), ("hi", pa.binary()), ("raw", pa.binary()), ("floor", pa.float64())])


def groups_of(blocks: DataFrame, n_anchors: int) -> DataFrame:
    """Anchors in the order of the curve, at most ``GROUP`` of one length a row."""
    order = ["d", "label", "key", "vec_id"]
    names = [c.split()[0] for c in _GROUP.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, k, held = TaskContext.get().partitionId(), 0, []

        def group() -> pa.RecordBatch:
            nonlocal k
            d = held[0]["d"]
            x = np.stack([_wide(r["raw"], 1, d)[0] for r in held])
            row = [(at << 32) + k, d, len(held), _i8([r["vec_id"] for r in held]), _i8([r["label"] for r in held]), _narrow(x), _f8([r["floor"] for r in held])]
            k += 1
            held.clear()
            return pa.record_batch([pa.array([c], t) for c, t in zip(row, (pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4), strict=True)], names)

        for b in batches:
            for r in b.to_pylist():
                if held and (len(held) >= GROUP or r["d"] != held[0]["d"]):
                    yield group()
                held.append(r)
        if held:
            yield group()

    anchors = blocks.filter("anchor").select(*order, "raw", "floor")
    dealt = anchors.repartitionByRange(max(1, -(-n_anchors // GROUP)), *order).sortWithinPartitions(*order)
    return written(blocks.sparkSession, dealt.mapInArrow(cut, _GROUP), "anchor-groups")


class Group:
    """A group row unpacked; ``p_row, p_id, p_score``: its positives by anchor, where they are known."""

    def __init__(self, r: dict):
        self.g, self.d, n = r["g"], r["d"], r["n"]
        self.ids, self.labels = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["labels"], "<i8")
        self.x, self.floors = _wide(r["raw"], n, self.d), np.frombuffer(r["floors"], "<f8")
        self.windows = None
        if r.get("positives") is not None:
            p = r["positives"]
            place = {v: i for i, v in enumerate(self.ids.tolist())}
            self.p_row, self.p_id = np.array([place[q["anchor_id"]] for q in p], np.int64), np.array([q["positive_id"] for q in p], np.int64)
            self.p_score = np.array([q["score"] for q in p], np.int64)
            self.windows = window(self.p_score)

    def needs(self, label: np.ndarray, label_to: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """(anchors or windows, zones): which zones may hold a result."""
        top = upper(self.x, lo, hi)
        if self.windows is None:
            return (self.labels[:, None] >= label) & (self.labels[:, None] <= label_to) & (top >= self.floors[:, None])
        other = ~((self.labels[:, None] == label) & (self.labels[:, None] == label_to))
        least, most = self.windows
        meets = (top[self.p_row] >= least[:, None]) & (lower(self.x, lo, hi)[self.p_row] <= most[:, None])
        return other[self.p_row] & (least <= most)[:, None] & meets


def _zone(rows: list[dict], d: int) -> tuple[np.ndarray, ...]:
    return (np.array([r["label"] for r in rows], np.int64), np.array([r["label_to"] for r in rows], np.int64), np.frombuffer(b"".join(r["lo"] for r in rows), "<f8").reshape(-1, d), np.frombuffer(b"".join(r["hi"] for r in rows), "<f8").reshape(-1, d))


def range_zones(blocks: DataFrame) -> dict[int, dict]:
    """The zone of every range (bounded by ``ZONE_NUMBERS``); ranges with several lengths have none."""
    def widest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zones: dict[tuple[int, int], dict] = {}
        for b in batches:
            for r in b.to_pylist():
                old = zones.setdefault((r["range"], r["d"]), r)
                old["label"], old["label_to"] = min(old["label"], r["label"]), max(old["label_to"], r["label_to"])
                for c, f in (("lo", np.minimum), ("hi", np.maximum)):
                    old[c] = f(np.frombuffer(old[c], "<f8"), np.frombuffer(r[c], "<f8")).tobytes()
        if zones:
            yield pa.RecordBatch.from_pylist(list(zones.values()), pa.schema([_ARROW_BLOCKS.field(c) for c in ("range", "d", "label", "label_to", "lo", "hi")]))

    zones = blocks.filter(~F.col("anchor")).select("range", "d", "label", "label_to", "lo", "hi")
    zones = zones.repartition(shuffle_partitions(blocks), "range").mapInArrow(widest, "range int, d int, label long, label_to long, lo binary, hi binary")
    single = zones.withColumn("lengths", F.count("*").over(Window.partitionBy("range")))
    several = F.col("lengths") > 1
    single = single.select("range", F.when(several, -1).otherwise(F.col("d")).alias("d"), "label", "label_to", *(F.when(~several, F.col(c)).alias(c) for c in ("lo", "hi")))
    return {r["range"]: r.asDict() for r in single.dropDuplicates(["range"]).collect()}


def chosen_blocks(groups: DataFrame, blocks: DataFrame, ranges: dict[int, dict]) -> DataFrame:
    """``g, range, block``: the blocks every group must read, by zones of ranges, then of blocks."""
    lengths: dict[int, list[dict]] = {}
    for r in ranges.values():
        lengths.setdefault(r["d"], []).append(r)
    zones = {d: (np.array([r["range"] for r in rows]), _zone(rows, d)) for d, rows in lengths.items() if d >= 0}
    mixed = np.array([r["range"] for r in lengths.get(-1, [])], np.int64)
    names = groups.columns

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, r in enumerate(b.to_pylist()):
                group, at = Group(r), mixed
                if group.d in zones:
                    number, zone = zones[group.d]
                    at = np.concatenate([mixed, number[group.needs(*zone).any(0)]])
                if len(at):
                    yield pa.record_batch([*(b.column(c).take(pa.array([i] * len(at))) for c in names), pa.array(at, pa.int32())], [*names, "range"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in groups.schema)
    sent = groups.mapInArrow(spread, f"{fields}, range int")
    zone_rows = blocks.filter(~F.col("anchor")).select("range", "block", "d", "label", "label_to", "lo", "hi")
    both = zone_rows.unionByName(sent, allowMissingColumns=True)
    both = both.repartition(shuffle_partitions(blocks), "range").sortWithinPartitions("range", F.asc_nulls_first("g"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, here, ready = None, {}, {}
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["range"] != at:
                    at, here, ready = r["range"], {}, {}
                if r["g"] is None:
                    here.setdefault(r["d"], []).append(r)
                    continue
                group = Group(r)
                if group.d not in here:
                    continue
                if group.d not in ready:
                    ready[group.d] = _zone(here[group.d], group.d)
                out += [(group.g, at, here[group.d][z]["block"]) for z in np.flatnonzero(group.needs(*ready[group.d]).any(0))]
            yield pa.record_batch([pa.array([r[c] for r in out], t) for c, t in enumerate((pa.int64(), pa.int32(), pa.int64()))], ["g", "range", "block"])

    return both.mapInArrow(choose, "g long, range int, block long")


# ---------------------------------------------------------------- solving


def _solve(groups: DataFrame, blocks: DataFrame, ranges: dict[int, dict], units: int, k: int) -> DataFrame:
    """``g, anchor_id, positive_id, positive_score, score, vec_id``: the ``k`` best of every anchor (``positive_id`` null)
    or window in every unit of blocks."""
    spark = blocks.sparkSession
    n_ranges = max(ranges) + 1
    pairs = written(spark, chosen_blocks(groups, blocks, ranges).withColumn("unit", F.floor(F.col("range") * F.lit(min(units, n_ranges)) / n_ranges).cast("int")), "block-pairs")
    data = blocks.filter(~F.col("anchor")).select("block", F.col("d").alias("bd"), F.col("n").alias("bn"), F.col("ids").alias("b_ids"), F.col("labels").alias("b_labels"), "lo", "hi", F.col("raw").alias("b_raw"), "label", "label_to")
    data = pairs.select("g", "unit", "block").join(data, "block")
    heads = pairs.select("g", "unit").distinct().join(groups, "g")
    both = data.unionByName(heads, allowMissingColumns=True)
    both = both.repartition(shuffle_partitions(blocks), "g", "unit").sortWithinPartitions("g", "unit", F.asc_nulls_first("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = leaders = None

        def done() -> Iterator[pa.RecordBatch]:
            if group is None or not len(leaders.rows):
                return
            r, n = leaders.rows, len(leaders.rows)
            if group.windows is None:
                anchor, positive, score = group.ids[r], pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())
            else:
                anchor, positive, score = group.ids[group.p_row[r]], pa.array(group.p_id[r]), pa.array(group.p_score[r])
            yield pa.record_batch([pa.array(np.full(n, group.g)), pa.array(anchor), positive, score, pa.array(leaders.score.astype(np.int64)), pa.array(leaders.ids)], ["g", "anchor_id", "positive_id", "positive_score", "score", "vec_id"])

        for b in batches:
            for i in range(b.num_rows):
                r = {c: b.column(c)[i].as_py() for c in b.schema.names}
                if r["block"] is None:
                    yield from done()
                    group = Group(r)
                    leaders = Leaders(len(group.ids), k, group.floors) if group.windows is None else Leaders(len(group.p_row), k, group.windows[0])
                    continue
                if r["bd"] != group.d:
                    continue
                ids, labels = np.frombuffer(r["b_ids"], "<i8"), np.frombuffer(r["b_labels"], "<i8")
                zone = _zone([r], group.d)
                may = group.needs(*zone)[:, 0]
                rows = np.flatnonzero(may & (upper(group.x, *zone[2:])[:, 0][slice(None) if group.windows is None else group.p_row] >= leaders.least))
                if not len(rows):
                    continue
                x = _wide(r["b_raw"], r["bn"], group.d)
                if group.windows is None:
                    s = scores(group.x[rows], x)
                    s[(group.labels[rows][:, None] != labels[None]) | (group.ids[rows][:, None] == ids[None])] = -np.inf
                else:
                    anchors, back = np.unique(group.p_row[rows], return_inverse=True)
                    s = scores(group.x[anchors], x)
                    s[group.labels[anchors][:, None] == labels[None]] = -np.inf
                    s = s[back]
                    s[(s < group.windows[0][rows][:, None]) | (s > group.windows[1][rows][:, None])] = -np.inf
                leaders.offer(rows, s, ids)
        yield from done()

    return both.mapInArrow(run, "g long, anchor_id long, positive_id long, positive_score long, score long, vec_id long")


def hard_negatives(vectors: DataFrame, is_anchor: Column) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows where ``is_anchor``
    holds, from columns ``vec_id``, ``embedding`` and ``label``."""
    spark = vectors.sparkSession
    rows = written(spark, usable(vectors, is_anchor), "negatives-vectors")
    size = rows.agg(F.max(F.size("v")).alias("d"), F.count_if("anchor").alias("n")).first()
    if not size["n"]:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    n_ranges = max(1, min(shuffle_partitions(rows), RANGES, ZONE_NUMBERS // size["d"]))
    blocks = blocks_of(keyed(rows, _moments(rows)), n_ranges)
    groups = groups_of(blocks, size["n"])
    ranges = range_zones(blocks)
    units = max(LEAST_UNITS, -(-blocks.filter(~F.col("anchor")).count() // BLOCKS_PER_UNIT))

    def ranked(found: DataFrame, k: int, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)

    positives = ranked(_solve(groups, blocks, ranges, units, POSITIVES), POSITIVES, "anchor_id")
    positives = positives.groupBy("g").agg(F.collect_list(F.struct("anchor_id", F.col("vec_id").alias("positive_id"), "score")).alias("positives"))
    wanted = written(spark, groups.join(positives, "g"), "anchor-windows")
    found = ranked(_solve(wanted, blocks, ranges, units, NEGATIVES), NEGATIVES, "anchor_id", "positive_id")
    return found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


SQL = f"""
WITH u AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: greatest(least(floor(CAST(x AS DOUBLE) * {SCALE}), {LARGEST!r}), {-LARGEST!r})) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE) * {SCALE}))) = len(embedding)),
t AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, v) = 1),
s AS (
  SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same, CAST(greatest(least(list_dot_product(a.v, x.v), {EXACT!r}), {-EXACT!r}) AS BIGINT) AS score
  FROM t a JOIN t x ON x.vec_id <> a.vec_id AND len(x.v) = len(a.v) WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id,
       p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= {NEGATIVES}
"""
