"""Personal data: fixed base patterns, and contextual extraction bootstrapped from them.

Base spans, per kind, are the leftmost non-overlapping matches of the ``email``, ``ip``,
``card`` and ``phone`` patterns that pass their test (parts up to 255, Luhn and 16 to 19 digits,
8 to 15 digits).

The contextual part takes as seeds the base spans and long hexadecimal keys (``SECRET`` digits or more). An instance is a
seed or another identifier-like word (two digits or an ``@``, four characters) that no base span touches. Patterns come in three
families: the two words to the left of an entity; the word to its left with its shape (kind of characters and
length); the words to its left and right. Spark scores the graph of patterns and instances: a pattern's confidence is
the lower end of the Wilson interval of its instances' mean score, so it needs many and nearly only good ones; an
instance scores 1 as a seed, else the noisy-or of its confident patterns. After ``ROUNDS`` rounds, the
identifier-like words and keys in the patterns at ``CONFIDENT`` or above become spans of the kind
``context``; a key in no such pattern stays.

A null text is the empty text; no span, no change. Rows are kept apart by id and text, so equal
ids with different texts have their own spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructType

from quayside.llm.common import written

KINDS = ("email", "ip", "card", "phone")
CONTEXT = "context"
ROUNDS = 3
CONFIDENT = 0.75
#: So many confident patterns (8 MB) are shipped to the tasks that mask.
SHIPPED = 1 << 20
#: A word of so many hexadecimal digits, of one case and both letters and digits, is a seed.
SECRET = 32
Z = 1.64
#: How far to the left of an entity its two words are looked for.
REACH = 200

# The base patterns are anchored where a match can only begin or end, so that no long run of
# letters or digits is scanned again and again; they match what the plain patterns match.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_BLANK = re.compile(r"[\x09-\x0D]")
_SIGN = re.compile(r"[0-9@]")
_EDGE = ".,;:!?\"'()[]{}<>|%$#*&=-_/\\"


def _emails(text: str) -> list[tuple[int, int]]:
    out, after = [], 0
    at = text.find("@")
    while at >= 0:
        if at >= after and (m := _DOMAIN.match(text, at + 1)):
            start = at
            while start > after and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            if start < at:
                out.append((start, m.end()))
                after = m.end()
        at = text.find("@", at + 1)
    return out


def _byte(digits: str) -> bool:
    """Whether the number is at most 255, however many zeros lead it."""
    digits = digits.lstrip("0")
    return len(digits) < 3 or len(digits) == 3 and digits <= "255"


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """(start, end) of every base span, a list per kind of ``KINDS``."""
    out: list[list[tuple[int, int]]] = [_emails(text) if "@" in text else [], [], [], []]
    if "." in text:
        out[1] = [m.span() for m in _IP.finditer(text) if all(_byte(p) for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out[2].append(m.span())
    if "+" in text:
        out[3] = [m.span() for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


def _number(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode()) - (1 << 63)


_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")


def _is_key(word: str) -> bool:
    return len(word) >= SECRET and _HEX.fullmatch(word) is not None and not word.isdigit() and any(c.isdigit() for c in word)


def _shape(word: str) -> str:
    """The kinds of characters of a word and its length: equal for identifiers of one make."""
    letters = "key" if _is_key(word) else "a" if any(c.isalpha() for c in word) else ""
    marks = "".join(sorted({c for c in word if not c.isalnum()}))
    return f"{letters}{'9' if any(c.isdigit() for c in word) else ''}{marks} {min(len(word), 65)}"


def _words(text: str) -> list[str]:
    return [w for w in (w.strip(_EDGE).lower() for w in text.split(" ")) if w]


def _patterns(flat: str, start: int, end: int) -> list[int]:
    """The patterns that the entity at [start, end) stands in, by number; families are told apart."""
    left, right = _words(flat[max(0, start - REACH) : start])[-2:], _words(flat[end : end + REACH])[:1]
    one, after = (left or [""])[-1], (right or [""])[0]
    word = flat[start:end]
    return [_number(f"2 {' '.join(left)}"), _number(f"s {one} {_shape(word)}"), _number(f"b {one} {after}")]


def entities(text: str, base: list[list[tuple[int, int]]]) -> list[dict]:
    """Seeds and identifier-like words: ``start, end, patterns, instance, seed``, and whether a base span (``known``)."""
    out = []
    flat = _BLANK.sub(" ", text)
    taken = sorted(s for kind in base for s in kind)
    for s, e in taken:
        out.append({"start": s, "end": e, "patterns": _patterns(flat, s, e), "instance": _number(text[s:e].lower()), "seed": True, "known": True})
    k, m = 0, _SIGN.search(flat)
    while m:
        s, e = flat.rfind(" ", 0, m.start()) + 1, flat.find(" ", m.start())
        e = len(flat) if e < 0 else e
        while k < len(taken) and taken[k][1] <= s:
            k += 1
        if not any(a < e and b > s for a, b in taken[k : k + 4]):
            word = flat[s:e].rstrip(_EDGE)
            s, e = s + len(word) - len(word.lstrip(_EDGE)), s + len(word)
            if e - s >= 4 and ("@" in flat[s:e] or sum(c in "0123456789" for c in flat[s:e]) >= 2):
                out.append({"start": s, "end": e, "patterns": _patterns(flat, s, e), "instance": _number(flat[s:e].lower()), "seed": _is_key(flat[s:e]), "known": False})
                m = _SIGN.search(flat, e)
                continue
        nxt = flat.find(" ", m.start())
        m = _SIGN.search(flat, nxt) if nxt >= 0 else None
    return out


_ENTITY = StructType().add("start", LongType()).add("end", LongType()).add("patterns", ArrayType(LongType())).add("instance", LongType()).add("seed", BooleanType()).add("known", BooleanType())


def find_base(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, counts`` (per kind), ``base`` (joined spans) and ``found`` entities."""
    schema = docs.select("doc_id").schema.add("text_key", LongType()).add("counts", ArrayType(LongType())).add("base", StringType()).add("found", ArrayType(_ENTITY))
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, bases, found = [], [], []
            for t in b.column(2):
                text = t.as_py() or ""
                base = base_spans(text)
                counts.append([len(x) for x in base])
                bases.append(",".join(f"{k}:{s}:{e}" for k, x in zip(KINDS, base, strict=True) for s, e in x))
                found.append(entities(text, base) if _SIGN.search(text) else [])
            yield pa.record_batch([b.column(0), b.column(1), pa.array(counts, arrow.field(2).type), pa.array(bases, pa.string()), pa.array(found, arrow.field(4).type)], schema=arrow)

    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("text_key"), text.alias("text")).mapInArrow(run, schema)


def _wilson(k: Column, n: Column) -> Column:
    p = k / n
    return (p + Z * Z / (2 * n) - Z * F.sqrt(F.greatest(F.lit(0.0), p * (1 - p) / n + Z * Z / (4 * n * n)))) / (1 + Z * Z / n)


def confident_patterns(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``pattern, confidence`` of the patterns at ``CONFIDENT`` or above."""
    spark = found.sparkSession
    one = found.select(F.explode("found").alias("e")).select(F.explode("e.patterns").alias("pattern"), "e.instance", "e.seed")
    edges = written(spark, one.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pii-edges")
    scored = edges.withColumn("score", F.col("seed").cast("double"))
    for turn in range(rounds):
        patterns = scored.groupBy("pattern").agg(_wilson(F.sum("score"), F.count("*")).alias("confidence"))
        good = written(spark, patterns.filter(F.col("confidence") >= 0.5), f"pii-patterns-{turn}")
        if turn == rounds - 1:
            break
        miss = edges.join(good, "pattern").groupBy("instance").agg(F.sum(F.log(1 - F.least("confidence", F.lit(0.999)))).alias("miss"))
        scored = edges.join(miss, "instance", "left").withColumn("score", F.when(F.col("seed"), 1.0).otherwise(1 - F.exp(F.coalesce("miss", F.lit(0.0)))))
    return good.filter(F.col("confidence") >= CONFIDENT)


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, counts, base, extra``: the joined base spans of every row, and those
    of the contextual part (empty if none)."""
    rows = written(docs.sparkSession, find_base(docs), "pii-found")
    return _joined(rows, confident_patterns(rows.select("found")))


def _joined(rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """The result of ``personal_data`` from ``find_base`` rows and the confident patterns."""
    more = rows.select("doc_id", "text_key", F.explode("found").alias("e")).filter("NOT e.known")
    more = more.select("doc_id", "text_key", F.explode("e.patterns").alias("pattern"), F.col("e.start").alias("start"), F.col("e.end").alias("end")).join(patterns, "pattern")
    spans = F.array_sort(F.collect_set(F.struct("start", "end")))
    more = more.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.lit(CONTEXT), s["start"], s["end"])), ",").alias("extra"))
    out = rows.join(more, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    return out.select("doc_id", "text_key", "counts", "base", F.coalesce("extra", F.lit("")).alias("extra"))


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_context``."""
    found = personal_data(docs)
    joined = F.concat_ws(",", F.nullif("base", F.lit("")), F.nullif("extra", F.lit("")))
    n_extra = F.when(F.col("extra") == "", 0).otherwise(F.size(F.split("extra", ","))).cast("long")
    return found.select("doc_id", *[F.element_at("counts", k + 1).alias(f"n_{x}") for k, x in enumerate(KINDS)], F.sha2("base", 256).alias("base_sha256"), joined.alias("spans"), n_extra.alias("n_context"))


def mask(text: str, spans: str) -> str:
    """The text with its spans replaced by their kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for s, e, kind in sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(",") if x)):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def _found_spans(text: str, patterns: np.ndarray) -> str:
    """All spans of a text, those of the contextual part by the numbers (ascending) of confident patterns."""
    base = base_spans(text)
    out = {f"{k}:{s}:{e}" for k, x in zip(KINDS, base, strict=True) for s, e in x}
    for e in entities(text, base) if _SIGN.search(text) else ():
        if not e["known"] and len(patterns):
            at = np.searchsorted(patterns, e["patterns"])
            if (patterns[np.minimum(at, len(patterns) - 1)] == e["patterns"]).any():
                out.add(f"{CONTEXT}:{e['start']}:{e['end']}")
    return ",".join(out)


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in ``text`` and ``n_chars`` (where present) counted anew.
    A row without spans stays as it is.

    Up to ``SHIPPED`` confident patterns go to the tasks, which mask every text where it is read. More of them
    are joined to the entities, and the spans to the texts."""
    spark = docs.sparkSession
    rows = written(spark, find_base(docs), "pii-found")
    patterns = written(spark, confident_patterns(rows.select("found")).select("pattern").distinct(), "pii-confident")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    if patterns.count() <= SHIPPED:
        known = np.sort(patterns.toArrow().column("pattern").to_numpy())

        @F.pandas_udf("string")
        def masked_text(text: pd.Series) -> pd.Series:
            spans = [_found_spans(t, known) if isinstance(t, str) else "" for t in text]
            return pd.Series([mask(t, x) if x else None for t, x in zip(text, spans, strict=True)], dtype=object)

        rows = docs.select(row.alias("d"), masked_text(F.col("text")).alias("_new"))
    else:
        found = _joined(rows, patterns).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.concat_ws(",", F.nullif("base", F.lit("")), F.nullif("extra", F.lit(""))).alias("_spans")).filter("_spans <> ''").dropDuplicates(["_id", "_key"])
        keyed = docs.select(row.alias("d"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text_key"))
        both = keyed.join(found, F.col("d.doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")), "left")

        @F.pandas_udf("string")
        def masked_by(text: pd.Series, spans: pd.Series) -> pd.Series:
            return pd.Series([mask(t, s) if isinstance(s, str) else None for t, s in zip(text, spans, strict=True)], dtype=object)

        # only texts with spans go to Python
        rows = both.select("d", masked_by(F.when(F.col("_spans").isNotNull(), F.col("d.text")), "_spans").alias("_new"))
    clean = F.col("_new").isNull()
    changed = {"text": F.coalesce("_new", "d.text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(clean, F.col("d.n_chars")).otherwise(F.length("_new")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[changed.get(c, F.col(f"d.`{c}`")).alias(c) for c in docs.columns])
