import hashlib
import itertools
import random
import zlib

import duckdb
from pyspark.sql import functions as F

from quayside.llm import repair
from quayside.llm.common import table
from quayside.llm.queries import op11_conversation_repair
from tests.conftest import SF_SMALL

WS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        own = out.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest())
    return {c: sorted(own, key=key) for c, own in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        kept = text.strip(WS)
        out.append("blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def paths(rows):
    """Every sensible edit sequence, as (cost, audit, repaired rows), by plain search over initials."""
    kinds = faults(rows)
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def go(i, last, cost, audit, done, fresh):
        if i == len(rows) and last in ("", "a"):
            yield cost, audit, done
        if fresh < 2:
            for c in after[last].replace("s", ""):
                yield from go(i, c, cost + 5, audit + "I", [*done, names[c] + ":"], fresh + 1)
        if i < len(rows):
            _, role, text = rows[i]
            yield from go(i + 1, last, cost + 2, audit + "D", done, 0)
            if kinds[i] not in ("blank", "duplicate"):
                more = 5 * (kinds[i] == "truncated")
                if role and role[0] in after[last]:
                    yield from go(i + 1, role[0], cost + more, audit + "K", [*done, f"{role}:{text}"], 0)
                for c in after[last].replace("s", ""):
                    yield from go(i + 1, c, cost + 1 + more, audit + "R", [*done, f"{names[c]}:{text}"], 0)

    return go(0, "", 0, "", [], 0)


def viterbi(rows):
    """The least (cost, audit) by states, left to right, for long conversations."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def closed(states):
        for _ in range(2):
            for last, (cost, audit, done) in list(states.items()):
                for c in after[last].replace("s", ""):
                    states[c] = min(states.get(c, (1e9, "", [])), (cost + 5, audit + "I", [*done, names[c] + ":"]))
        return states

    states = closed({"": (0, "", [])})
    for (_, role, text), kind in zip(rows, faults(rows), strict=True):
        new = {}
        for last, (cost, audit, done) in states.items():
            options = [(last, (cost + 2, audit + "D", done))]
            if kind not in ("blank", "duplicate"):
                more = 5 * (kind == "truncated")
                options += [(role[0], (cost + more, audit + "K", [*done, f"{role}:{text}"]))] if role and role[0] in after[last] else []
                options += [(c, (cost + 1 + more, audit + "R", [*done, f"{names[c]}:{text}"])) for c in after[last].replace("s", "")]
            for c, o in options:
                new[c] = min(new.get(c, (1e9, "", [])), o)
        states = closed(new)
    return min(states[q] for q in ("", "a") if q in states)


def brute(rows, search=viterbi):
    out = set()
    for conv, own in damage(rows).items():
        turns = {t for t, _, _ in own if t is not None}
        gaps = min(max(turns) - min(turns) + 1 - len(turns), (1 << 63) - 1) if turns else 0
        kinds = faults(own)
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit, done = search(own)
        out.add((conv, gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(done).encode()).hexdigest()))
    return out


def got(df):
    rows = [tuple(r) for r in repair.repair_report(df).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_rows(rng, n_conv, most):
    roles, texts = ["user", "assistant", "system", "tool", "", None, "usher"], ["yes.", "no", "why?", " ", None, "ok! \n", "done.\t", ""]
    out = []
    for conv in range(n_conv):
        for turn in range(rng.randint(1, most)):
            role = rng.choice(roles) if rng.random() < 0.4 else ["user", "assistant"][turn % 2]
            text = rng.choice(texts) if rng.random() < 0.4 else f"turn {turn} of it."
            out.append((conv, None if rng.random() < 0.05 else turn + (turn > 3), role, text))
    return out


def test_against_all_edit_sequences(spark):
    """The least (cost, audit) over every sequence, so also that least audits of halves make the least."""
    rows = random_rows(random.Random(5), 60, 5)
    want = brute(rows, lambda own: min(paths(own)))
    assert want == brute(rows)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(4)) == want


def test_cells_do_not_depend_on_the_split():
    rng = random.Random(3)
    for _ in range(30):
        letters = bytes(rng.choice(range(65, 81)) for _ in range(rng.randint(1, 40)))
        whole = repair.span_cell(letters)
        k = rng.randint(0, len(letters))
        assert repair.join(repair.span_cell(letters[:k]), repair.span_cell(letters[k:])) == repair.join(whole, repair.span_cell(b"")) or k in (0, len(letters))
        left = repair.span_cell(b"")
        for x in letters:
            left = repair.join(left, repair.row_cell(x))
        assert left == whole


def test_long_conversation_over_many_ranges(spark, monkeypatch):
    """One conversation of a third of all rows (and longer than a leaf) is parsed in several ranges."""
    monkeypatch.setattr(repair, "LEAF", 64)
    rng = random.Random(8)
    rows = random_rows(rng, 300, 8)
    rows += [(1000, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["a.", "b", f"t{t}.", f"t{t}!"])) for t in range(700)]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "hello."), (None, None, None, None), (None, 1, "assistant", "yes."), (2, 0, "user", "x" * 200_000 + "."), (2, 1, "assistant", "é? "), (2, 1, "assistant", "é? ")]
    rows += [(3, 7, "user", "a."), (3, 7, "assistant", "b."), (3, 7, "user", "a."), (-4, None, "user", "q?"), (5, -(1 << 62), "user", "a."), (5, (1 << 62) + 5, "assistant", "b.")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("m", "letter", "audit", "cost", "k1", "place", "later", "_kind")})
    assert got(df.repartition(3)) == brute(rows)
    assert got(spark.createDataFrame([], SCHEMA)) == set()
    gone = next(k for k in range(100) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    want = (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got(spark.createDataFrame([(gone, 0, "user", "a.")], SCHEMA)) == {want}
    texts = spark.createDataFrame([("a", 0, "user", "hm."), ("b", 1, "user", "hm.")], "conv_id string, turn long, role string, text string")
    assert {r[0] for r in got(texts)} == {"a", "b"}


def test_repaired_rows(spark):
    rows = random_rows(random.Random(9), 40, 6)
    df = spark.createDataFrame(rows, SCHEMA)
    convs = {}
    for r in sorted(repair.repair(df).collect(), key=lambda r: (r["conv_id"], r["place"])):
        convs.setdefault(r["conv_id"], []).append(r)
    for row in got(df):
        own = convs.get(row[0], [])
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in own).encode()).hexdigest() == row[8]
        assert "".join(r["edit"] for r in own) == row[7].replace("D", "")
        assert [r["place"] for r in own] == list(range(len(own)))


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "conversations").collect()]
    assert {tuple(r) for r in op11_conversation_repair(spark, SF_SMALL).collect()} == brute(rows)
    assert sql(rows) == brute(rows)


def sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return set(con.execute(repair.SQL).fetchall())


def test_sql_on_odd_rows():
    rows = random_rows(random.Random(12), 150, 6) + [(None, 0, "user", "hello."), (None, None, None, None), (-3, 1, "assistant", "yes. \x0b"), (-3, 1, "assistant", "yes. \x0b")]
    assert sql(rows) == brute(rows)
