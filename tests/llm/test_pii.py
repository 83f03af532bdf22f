import hashlib
import random
import re

from quayside.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    def ok(kind, m):
        d = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            return 16 <= len(d) <= 19 and pii._luhn(d)
        return kind != "phone" or 8 <= len(d) <= 15

    return [[m.span() for m in re.finditer(p, text) if ok(k, m.group())] for k, p in PLAIN.items()]


def test_base_spans_match_the_plain_patterns():
    rng = random.Random(1)
    parts = ["1", "47", "0", ".", "@", "a", "b", "-", " ", "+", "(", ")", "255", "256", "4539578763621486", "\n", "%", "x@y.z", "١", "+1 (017) 555-7713"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_of_zeros():
    text = "0" * 5000 + ".1.1.1 and 1.2.3." + "0" * 9000 + "255 not 1.1.1.0256"
    assert pii.base_spans(text)[1] == [(0, 5006), (5011, 5011 + 6 + 9003)]
    assert [pii._byte(x) for x in ("", "0", "9", "99", "255", "256", "300", "0255", "1000")] == [True] * 5 + [False, False, True, False]


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "+1" + "(" * 200_000, "@" * 100_000, "a@" * 100_000):
        pii.entities(text, pii.base_spans(text))


def test_report_and_masking(messy, spark, no_docs):
    extra = spark.createDataFrame([(70, "mail me at ann@example.com or +1 (017) 555-7713 now", "en", "s0", 51), (71, "from 10.1.2.3 to 10.1.2.999 with 4539 5787 6362 1486", "en", "s0", 50)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = messy.select("doc_id", "text", "lang", "source", "n_chars", "d", "_id").unionByName(extra, allowMissingColumns=True)
    got = {r["doc_id"]: r for r in pii.report(docs).collect()}
    for r in docs.collect():
        spans = plain(r["text"] or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, x in zip(PLAIN, spans, strict=True) for s, e in x)
        row = got[r["doc_id"]]
        assert [row[f"n_{k}"] for k in PLAIN] == [len(x) for x in spans]
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest() and row["spans"] == joined and row["n_context"] == 0
    out = pii.masked(docs)
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert out.columns == docs.columns and out.count() == docs.count()
    assert texts[70] == ("mail me at [EMAIL] or [PHONE] now", 33) and texts[71][0] == "from [IP] to 10.1.2.999 with [CARD]"
    assert texts[50] == (None, None) and texts[51] == ("", 0)
    assert pii.report(no_docs).count() == 0 and pii.masked(no_docs).count() == 0


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    names = [f"user{k}" for k in range(40)]
    docs = [(k, f"filler words then contact desk {n}@example.com thanks row {k}{k}") for k, n in enumerate(names)]
    docs += [(100, "please contact desk AB-9912-77 today"), (101, "the year was 1987 and row 4455"), (102, "nobody would contact desk quickly")]
    got = {r["doc_id"]: r["spans"] for r in pii.report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    start = docs[-3][1].index("AB-9912-77")
    assert got[100] == f"context:{start}:{start + 10}"
    assert got[101] == "" and got[102] == "" and "context" not in got[3]


def test_keys_are_found_by_their_context(spark, monkeypatch):
    """Planted keys after ``token =`` and identifiers of other makes in contexts of seeds: found; the same shapes
    elsewhere, keys in contexts of their own included, are left alone."""
    import random

    rng = random.Random(3)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    words = [f"w{''.join(rng.choice('abcdefgh') for _ in range(5))}".replace("w", "v") for _ in range(400)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs, want = [], {}
    for k in range(60):
        t = f'{some(4)} token = "'
        secret = key().upper() if k % 5 == 0 else key()
        docs.append((k, f'{t}{secret}" {some(3)}'))
        want[k] = f"context:{len(t)}:{len(t) + 40}"
    docs += [(100 + k, f"{some(3)} wrote to badge {rng.choice(words)}{k}@mail.example.com {some(2)}") for k in range(40)]
    t = f"{some(3)} wrote to badge "
    docs += [(200, f"{t}QX-55-191 {some(2)}")]
    want[200] = f"context:{len(t)}:{len(t) + 9}"
    docs += [(300 + k, f"{some(5)} {rng.randint(10**15, 10**16 - 1)} {some(4)} {rng.randint(1900, 2020)} {some(3)} sum {key()}") for k in range(3)]
    docs += [(400 + k, f"{some(2)} {rng.choice(words)} {rng.randint(1000, 99999)} {some(6)}") for k in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    shipped = {r["doc_id"]: r["text"] for r in pii.masked(df).collect()}
    monkeypatch.setattr(pii, "SHIPPED", -1)  # the other way: spans joined to the texts
    assert {r["doc_id"]: r["text"] for r in pii.masked(df).collect()} == shipped and "[CONTEXT]" in shipped[0]
    got = {r["doc_id"]: [x for x in r["spans"].split(",") if x.startswith("context")] for r in pii.report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    found = {(d, x) for d, own in got.items() for x in own}
    planted = set(want.items())
    assert len(found & planted) / len(planted) >= 0.95 and len(found & planted) / len(found) >= 0.95
    assert not any(got[d] for d in got if d >= 300)


def test_shapes():
    assert pii._shape("ab12") == "a9 4" and pii._shape("12-34") == "9- 5" and pii._is_key("0a" * 16) and not pii._is_key("0a" * 15) and not pii._is_key("1" * 40)
    assert pii._shape("0a" * 20) == "key9 40" == pii._shape("B7" * 20)


def test_overlapping_spans_become_one():
    assert pii.mask("ab cd ef", "email:0:5,ip:3:8") == "[EMAIL]" and pii.mask("ab", "") == "ab"
