"""Near-duplicate classes by BagMinHash signatures of weighted five-word shingles.

1. Every text becomes the multiset of its five-word shingles (lower case; words are runs of
   letters, digits and non-ASCII characters; a shorter text is one shingle). Texts with
   equal word sequences are one class at once, by a 128-bit key, and go on as one text under it.
2. BagMinHash: a shingle of weight w owns one Poisson process over time and weight [0, w) and
   ``REGISTERS`` registers. The weight axis is cut into dyadic intervals, each with a process of its
   own, seeded by shingle and interval; of the highest interval only points below w count. A
   register holds its earliest point. Two documents agree in a register with the probability
   of their weighted Jaccard similarity. A process ends at the time by which all registers
   are filled, so a long document costs little more than one draw per shingle.
3. ``BANDS`` bands of ``ROWS`` registers are hashed to buckets. Two documents of similarity 0.8 share
   a bucket with probability 1 - 3e-6.
4. Inside a bucket every text is checked against a leader, the member that shares most buckets
   with others: the multiset overlap of the shingles themselves, at least ``THRESHOLD``. Links
   join classes. In a bucket that still holds several classes, the members outside its largest class are
   compared with all others, in blocks inside tasks: by signature first, then by overlap. So no
   link is lost to a bucket's size, and no bucket is expanded into rows for its pairs.

Result: one row per row of the input with its class, the least id in it. A null text, or one
without words, is alone. A row with a null id has the class of its near copies with ids, else null.
Texts are told apart by their key, not their id: different texts of one id are in classes of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from quayside.llm.common import IS_MARK, byte_rows, mix64, row_sums, slices, span_hashes, word_spans, written
from quayside.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
ROWS = 4
BANDS = 24
REGISTERS = ROWS * BANDS
#: Pairs whose signatures agree in a smaller share of registers are not verified in blocks:
#: 4.9 standard deviations below 0.8.
LEAST_ESTIMATE = 0.6
BLOCK = 1_024
#: Bytes of text worked on at once; a task holds some 60 times as much.
SLICE = 1 << 19
MEMBERS_PER_TASK = 2_000
#: Bits of the table of wanted texts: eight for each text, between these powers of two (2 and 32 MB).
FILTER_BITS, MOST_FILTER_BITS = 24, 28
_U = np.uint64
_C1, _C2 = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
_PLACE = mix64(np.arange(1, SHINGLE + 1, dtype=np.uint64) * _C2) | _U(1)


def shingles(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lower-case byte texts: (row, shingle hash, weight) of the distinct shingles, ordered by
    row and hash, and two 64-bit keys of each row's word sequence (0 for no words)."""
    starts, ends, counts = word_spans(data, off, IS_MARK)
    w = span_hashes(data, starts, ends)
    first = np.concatenate([[0], np.cumsum(counts)])
    place = np.arange(len(w)) - np.repeat(first[:-1], counts)
    keys = []
    for c in (_C1, _C2):
        keys.append(mix64(row_sums(mix64(w + place.astype(np.uint64) * c), counts)) * (counts > 0))
    n = np.where(counts >= SHINGLE, counts - SHINGLE + 1, (counts > 0).astype(np.int64))
    row = np.repeat(np.arange(len(counts)), n)
    at = np.repeat(first[:-1], n) + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    h = np.zeros(len(row), np.uint64)
    short = counts[row] < SHINGLE
    for k in range(SHINGLE):
        ok = ~short | (k < counts[row])
        h += np.where(ok, w[np.minimum(at + k, max(len(w) - 1, 0))], _U(0)) * _PLACE[k] if len(w) else _U(0)
    h = mix64(h)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return row[at], h[at], np.diff(np.append(at, len(row))), *keys


def bag_minhash(row: np.ndarray, h: np.ndarray, weight: np.ndarray, n_rows: int, m: int = REGISTERS) -> np.ndarray:
    """(rows, m) uint32 signatures of weighted sets given as (row, element hash, whole weight)."""
    reg = np.full(n_rows * m, np.inf)
    total = np.bincount(row, weights=weight, minlength=n_rows)
    levels = np.zeros(len(weight), np.int64)
    left = weight - 1
    while left.any():  # dyadic intervals [0,1), [1,2), [2,4) ... that begin below the weight
        levels += left > 0
        left = left >> 1
    n = levels + 1
    element = np.repeat(np.arange(len(row)), n)
    level = np.arange(len(element)) - np.repeat(np.cumsum(n) - n, n)
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    width = np.maximum(low, 1.0)
    seed = mix64(h[element] ^ (level.astype(np.uint64) * _C2))
    prow, cap = row[element], weight[element].astype(float)
    spare = 4.0
    todo = np.flatnonzero(total > 0)
    while len(todo):
        end = np.zeros(n_rows)
        end[todo] = (np.log(m) + spare) / total[todo]
        act = np.flatnonzero(end[prow] > 0)
        t, r, lo, wd, up, stop = np.zeros(len(act)), prow[act], low[act], width[act], cap[act], end[prow[act]]
        s = seed[act].copy()
        while len(act):
            s = mix64(s + _C1)
            t = t - np.log(((s >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53) / (m * wd)
            go = t < stop
            if not go.all():
                s, t, r, lo, wd, up, stop = (x[go] for x in (s, t, r, lo, wd, up, stop))
            if not len(s):
                break
            z = mix64(s ^ _C2)
            at = r * m + ((z & _U(0xFFFFFFFF)) % _U(m)).astype(np.int64)
            inside = lo + (z >> _U(32)).astype(np.float64) * 2.0**-32 * wd < up
            if inside.all():
                np.minimum.at(reg, at, t)
            else:
                np.minimum.at(reg, at[inside], t[inside])
        todo = todo[np.isinf(reg.reshape(n_rows, m)[todo]).any(1)]
        spare *= 3
    return (mix64(reg.view(np.uint64)) >> _U(32)).astype(np.uint32).reshape(n_rows, m)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(rows, BANDS) int64 bucket keys."""
    s = signature.reshape(-1, BANDS, ROWS).astype(np.uint64)
    return mix64((mix64(s + _C1) * _PLACE[:ROWS]).sum(2) + np.arange(1, BANDS + 1, dtype=np.uint64) * _C2).view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, slot, row, key, bands, sig`` of every row, ``row`` being a number of its own; no
    words: key, bands and signature null."""
    schema = docs.select("doc_id").schema.add("text_key", "long").add("slot", "long").add("row", "long").add("key", "binary").add("bands", ArrayType(LongType())).add("sig", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for b in batches:
            data, off = byte_rows(b.column(1), lower=True)
            for i, j, d, o in slices(data, off, SLICE):
                row, h, weight, k1, k2 = shingles(d, o)
                some = np.zeros(j - i, bool)
                some[row] = True
                sig = bag_minhash(row, h, weight, j - i)
                keys = band_keys(sig)
                none = pa.array(~some)
                full = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32()), pa.array(keys.ravel()), mask=none)
                yield pa.record_batch([
                    b.column(0).slice(i, j - i), b.column(2).slice(i, j - i), b.column(3).slice(i, j - i), pa.array(np.arange(number, number + j - i)), _keys(k1, k2, some),
                    full, pa.array([x.tobytes() if s else None for x, s in zip(sig, some, strict=True)], pa.binary()),
                ], schema.names)
                number += j - i

    return docs.select("doc_id", "text", text_key(), _slot().alias("slot")).mapInArrow(run, schema)


def _keys(k1: np.ndarray, k2: np.ndarray, some: np.ndarray) -> pa.Array:
    """The 128-bit keys as 16 bytes, null where not ``some``."""
    return pa.array([x.tobytes() if s else None for x, s in zip(np.stack([k1, k2], 1), some, strict=True)], pa.binary())


def text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")


def _slot() -> Column:
    """The number of a row by which it is wanted or not, from its id and text."""
    return F.pmod(F.xxhash64("doc_id", F.coalesce("text", F.lit(""))), F.lit(1 << MOST_FILTER_BITS))


def shingle_sets(docs: DataFrame, wanted: DataFrame, n_texts: int) -> DataFrame:
    """``key, bag`` of the texts whose ``slot`` is in ``wanted`` and perhaps some others: the multiset of
    shingles as sorted 32-bit numbers, one per shingle and occurrence.

    A bit table, sized by the number of different texts ``n_texts``, lets the tasks pass by
    texts that nobody asks for; rows that fall on a set bit by chance only cost their work."""
    bits = min(MOST_FILTER_BITS, max(FILTER_BITS, (8 * n_texts).bit_length()))
    places = wanted.select(F.pmod("slot", F.lit(1 << bits)).alias("s"))
    hits = places.groupBy(F.expr("s div 32").alias("w")).agg(F.expr("bit_or(shiftleft(1L, CAST(s % 32 AS INT)))").alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 5), np.uint32)
    table[hits.column("w").to_numpy()] = hits.column("bits").to_numpy().astype(np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slot = np.asarray(b.column(1)) & ((1 << bits) - 1)
            ask = ((table[slot >> 5] >> (slot & 31).astype(np.uint32)) & 1).astype(bool)
            b = b.filter(pa.array(ask))
            data, off = byte_rows(b.column(0), lower=True)
            for i, j, d, o in slices(data, off, SLICE):
                row, h, weight, k1, k2 = shingles(d, o)
                some = np.zeros(j - i, bool)
                some[row] = True
                nth = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
                row = np.repeat(row, weight)
                v = (mix64(np.repeat(h, weight) + nth.astype(np.uint64) * _C1) >> _U(32)).astype(np.uint32)
                cut = np.searchsorted(row, np.arange(j - i + 1))
                bags = pa.array([np.unique(v[x:y]).tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
                yield pa.record_batch([_keys(k1, k2, some), bags], ["key", "bag"])

    return docs.select("text", _slot().alias("slot")).mapInArrow(run, "key binary, bag binary").filter("key IS NOT NULL")


def verified(docs: DataFrame, slots: DataFrame, pairs: DataFrame, n_texts: int) -> DataFrame:
    """The (a, b) of ``pairs``, keys of texts with their ``slots``, whose multisets overlap by ``THRESHOLD`` or more. ``a`` is a leader:
    its bag is sent once to every ``MEMBERS_PER_TASK`` members or so, theirs stream past it."""
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    bags = shingle_sets(docs, slots.join(keys, "key"), n_texts).dropDuplicates(["key"])
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS_PER_TASK).cast("int").alias("n"))
    members = pairs.join(salts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("n")).cast("int").alias("salt"), F.col("b").alias("key"))
    leads = salts.select("a", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("salt"), F.col("a").alias("key"))
    roles = leads.withColumn("lead", F.lit(True)).union(members.withColumn("lead", F.lit(False)))
    sent = roles.join(bags, "key").select("a", "salt", "lead", "key", "bag")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = sent.repartition(parts, "a", "salt").sortWithinPartitions("a", "salt", F.col("lead").desc())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, bag = None, None
        for batch in batches:
            out: list[tuple] = []
            for a, is_lead, doc, blob in zip(*[batch.column(k).to_pylist() for k in (0, 2, 3, 4)], strict=True):
                own = np.frombuffer(blob, np.uint32)
                if is_lead:
                    lead, bag = a, own
                elif a == lead:
                    if min(len(own), len(bag)) < THRESHOLD * max(len(own), len(bag)):
                        continue
                    both = np.sort(np.concatenate([own, bag]))
                    same = int((both[1:] == both[:-1]).sum())
                    if same >= THRESHOLD * (len(own) + len(bag) - same):
                        out.append((a, doc))
            yield pa.record_batch([pa.array([p[k] for p in out], pa.binary()) for k in (0, 1)], ["a", "b"])

    return sent.mapInArrow(run, "a binary, b binary")


def overlaps(bag: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Multiset Jaccard similarity of one bag with each of the others."""
    size = np.array([len(x) for x in others])
    flat = np.concatenate(others)
    hit = bag[np.minimum(np.searchsorted(bag, flat), len(bag) - 1)] == flat
    same = row_sums(hit.astype(np.int64), size)
    return same / (size + len(bag) - same)


def links_between(group: list[tuple], n_roots: dict) -> list[tuple]:
    """Members (probe?, key, root, signature, bag) of a block of a bucket → links between
    different roots, enough to join all that are linked: a probe is compared with every member
    whose root is not yet joined with its own."""
    def find(r):
        while n_roots.setdefault(r, r) != r:
            r = n_roots[r]
        return r

    data = [g for g in group if not g[0]]
    if not data:
        return []
    sig = np.stack([np.frombuffer(g[3], np.uint32) for g in data])
    bags = [np.frombuffer(g[4], np.uint32) for g in data]
    out = []
    for _, doc, root, s, bag in (g for g in group if g[0]):
        near = np.flatnonzero((sig == np.frombuffer(s, np.uint32)).mean(1) >= LEAST_ESTIMATE)
        near = [k for k in near if find(data[k][2]) != find(root)]
        if near:
            for k, j in zip(near, overlaps(np.frombuffer(bag, np.uint32), [bags[k] for k in near]), strict=True):
                if j >= THRESHOLD and find(data[k][2]) != find(root):
                    n_roots[find(data[k][2])] = find(root)
                    out.append((doc, data[k][1]))
    return out


def links_in_buckets(docs: DataFrame, slots: DataFrame, rows: DataFrame, sigs: DataFrame, n_texts: int) -> DataFrame:
    """(bucket, key, root) of buckets with several roots → (a, b) links between them.

    Members of the bucket's commonest root need no comparison with each other. All members are dealt
    once over blocks of about ``BLOCK``; those of the other roots also go to every block as
    probes. So a bucket of n members with r others costs n + r * n / BLOCK rows."""
    spark = rows.sparkSession
    per_root = rows.groupBy("bucket", "root").count()
    main = per_root.groupBy("bucket").agg(F.max_by("root", F.struct("count", "root")).alias("main"), F.ceil(F.sum("count") / BLOCK).cast("int").alias("n"))
    bags = shingle_sets(docs, slots.join(rows.select("key").distinct(), "key"), n_texts).dropDuplicates(["key"])
    placed = rows.join(main, "bucket").join(sigs.join(bags, "key"), "key")
    own = F.struct(F.pmod(F.xxhash64("key"), F.col("n")).cast("int").alias("block"), F.lit(False).alias("probe"))
    every = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda b: F.struct(b.alias("block"), F.lit(True).alias("probe")))
    tasks = placed.withColumn("t", F.explode(F.when(F.col("root") == F.col("main"), F.array(own)).otherwise(F.concat(F.array(own), every))))
    tasks = tasks.select("bucket", "t.block", "t.probe", "key", "root", "sig", "bag")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = tasks.repartition(parts, "bucket", "block").sortWithinPartitions("bucket", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, joined = None, [], {}

        def done() -> pa.RecordBatch:
            got = links_between(group, joined)
            return pa.record_batch([pa.array([p[k] for p in got], pa.binary()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key != r[:2]:
                    yield done()
                    key, group = r[:2], []
                group.append(r[2:])
        yield done()

    return tasks.mapInArrow(run, "a binary, b binary").distinct()


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, class_id, class_key`` for every row of ``docs``: the class' least id, if any
    row of it has one, and the key of one of its texts, null for a text without words."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    signed = written(spark, signatures(docs), "bag-signatures")
    heads = signed.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("head"), F.min(F.struct("row", "slot")).alias("x"))
    heads = written(spark, heads.select("key", "head", "x.row", "x.slot"), "bag-heads")
    slots, n_texts = heads.select("key", "slot"), heads.count()
    reps = signed.select("row", "key", "bands", "sig").join(heads.select("row"), "row", "left_semi")
    banded = reps.select("key", F.explode("bands").alias("bucket"))
    buckets = banded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    shared = written(spark, banded.join(buckets, "bucket"), "bag-buckets")

    degree = shared.groupBy("key").agg(F.sum("n").alias("degree"))
    leads = shared.join(degree, "key").groupBy("bucket").agg(F.max_by("key", F.struct("degree", "key")).alias("lead"))
    pairs = shared.join(leads, "bucket").filter("key <> lead").select(F.col("lead").alias("a"), F.col("key").alias("b")).distinct()
    links = written(spark, verified(docs, slots, written(spark, pairs, "bag-pairs"), n_texts), "bag-links")
    roots = components(links)

    # buckets of three or more that still hold several classes, one of each set of members
    known = shared.filter("n > 2").join(roots.withColumnRenamed("node", "key"), "key", "left").select("bucket", "key", F.coalesce("root", "key").alias("root"))
    known = written(spark, known, "bag-known")
    mixed = known.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("key")).alias("set")).filter("r0 <> r1")
    mixed = mixed.groupBy("set", "n").agg(F.min("bucket").alias("bucket"))
    rows = written(spark, known.join(mixed.select("bucket"), "bucket"), "bag-mixed")
    if rows.limit(1).count():
        more = links_in_buckets(docs, slots, rows, reps.select("key", "sig"), n_texts)
        links = written(spark, links.union(more), "bag-links")
        roots = components(links)

    placed = heads.join(roots.withColumnRenamed("node", "key"), "key", "left").select("key", "head", F.coalesce("root", "key").alias("class_key"))
    least = placed.groupBy("class_key").agg(F.min("head").alias("class_id"))
    placed = placed.select("key", "class_key").join(least, "class_key")
    out = signed.select("doc_id", "text_key", "key").join(placed, "key", "left")
    return out.select("doc_id", "text_key", F.coalesce("class_id", "doc_id").alias("class_id"), "class_key")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, class_id`` for every row of ``docs``; ``text_key`` tells apart the
    texts of rows with an equal id."""
    return classes(docs).drop("class_key")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one document of every class: its least id, or one without an id
    if none has one. Of texts without words every different id and text stays."""
    rows = classes(docs)
    alone = [F.when(F.col("class_key").isNull(), F.col(c)).alias(f"_{c}") for c in ("doc_id", "text_key")]
    best = rows.groupBy("class_key", *alone).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("k")).select(F.col("k.doc_id").alias("_id"), F.col("k.text_key").alias("_key"))
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"), text_key().alias("_text_key"))
    kept = kept.join(best, F.col("d.doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")), "left_semi")
    kept = kept.select("d", F.col("d.doc_id").alias("_id"), "_text_key").dropDuplicates(["_id", "_text_key"])
    return kept.select(*[F.col(f"d.`{c}`").alias(c) for c in docs.columns])
