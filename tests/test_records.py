import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from quayside.operators.land import land_archive_members, landed_keys
from quayside.plans.run import run_load
from quayside.sources.archives import archive_members, scan_archives
from quayside.sources.landing import landing_manifest
from quayside.sources.records import PartStream, Records
from quayside.streaming import fsutil
from quayside.streaming.ingest import IngestOptions

TEXT = (b'id,"the, note",x\n1,"two\nlines, ""so",5\n2,5" pipe,"a\n"\n3,"back\\"slash\n\\\\",7\n\n4,,"\n\n"\n"5\n",it"s,\n6,"x\\\\"\n7,"end"\n')


def ends(data, line_end=b"\n"):
    """Record ends by a byte-at-a-time machine."""
    out, state, i = [], "start", 0
    while i < len(data):
        c = data[i : i + 1]
        if state == "quoted":
            if c == b"\\":
                i += 1
            elif c == b'"':
                state = "plain"
        elif c == line_end:
            out.append(i + 1)
            state = "start"
        elif c == b"," or (c in b"\r\n"):
            state = "start"
        elif c == b'"' and state == "start":
            state = "quoted"
        else:
            state = "plain"
        i += 1
    return out


def found(data, size, line_end=b"\n"):
    records, out, at = Records(), [], 0
    for p in range(0, len(data), size):
        piece, i = data[p : p + size], 0
        while i < len(piece):
            i, ended = records.advance(piece, i, 0)
            if ended:
                out.append(at + i)
        at += len(piece)
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 5, 7, 16, 1000])
def test_record_ends_for_every_piece_size(size):
    assert found(TEXT, size) == ends(TEXT)
    cr = TEXT.replace(b"\n", b"\r")
    assert found(cr, size) == ends(cr, b"\r")


def test_random_streams():
    rng = random.Random(4)
    for _ in range(400):
        data = b"a\n" + bytes(rng.choice(b'ab,"\\\n\n,"') for _ in range(rng.randint(1, 60)))
        assert found(data, rng.randint(1, 12)) == ends(data), data


def parts_of(data, piece, size):
    stream = PartStream((data[i : i + piece] for i in range(0, len(data), piece)), size)
    out = []
    while stream.more:
        out.append(b"".join(stream.part()))
    return out


def test_parts_hold_whole_records_after_the_header():
    header = TEXT[: ends(TEXT)[0]]
    for piece in (1, 4, 64, 1000):
        for size in range(1, len(TEXT) + 2):
            parts = parts_of(TEXT, piece, size)
            assert parts[0] + b"".join(p[len(header) :] for p in parts[1:]) in (TEXT, TEXT.rstrip(b"\n") + b"\n")
            assert all(p.startswith(header) for p in parts) and all(p != header for p in parts[1:])
            assert all(len(p) <= size + len(header) + 40 for p in parts)
    assert parts_of(b"\n\n" + TEXT, 3, 20)[1].startswith(header)
    assert parts_of(b"", 3, 20) == [b""] and parts_of(b"\n\n", 1, 1) == [b"\n\n"]
    assert parts_of(b'a\n"never closed\n\n\n\n', 2, 3) == [b'a\n', b'a\n"never closed\n\n\n\n'] or len(parts_of(b'a\n"never closed\n\n\n\n', 2, 3)) <= 2


def big_zip(path, rows):
    lines = ['Id,"Note, long",N']
    for i in range(rows):
        lines.append(f'{i},"line one of {i}\nline \\"two\\", {i}\n\n",{i % 7}' if i % 3 else f'{i},plain 5\\" {i},{i % 7}')
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("data.csv", "\n".join(lines))
        z.writestr("small.csv", "Id,N\n1,2\n")
    with open(path, "wb") as f:
        f.write(buf.getvalue())
    return "\n".join(lines)


def test_big_member_lands_as_several_files_of_equal_rows(spark, tmp, monkeypatch):
    import os

    os.makedirs(f"{tmp}/z")
    text = big_zip(f"{tmp}/z/a.zip", 3000)
    whole = f"{tmp}/whole.csv"
    with open(whole, "w", newline="") as f:
        f.write(text)
    listed = archive_members(scan_archives(spark, f"{tmp}/z", with_md5=False)).select(
        "archive_path", "member", "size_bytes", F.lit("ds").alias("dataset"), F.lit(2024).alias("year"), F.lit(1).alias("month"))
    report = land_archive_members(spark, listed, f"{tmp}/land", multi_line=True, part_bytes=20_000).collect()
    files = landing_manifest(spark, f"{tmp}/land").collect()
    parts = sorted(r.part for r in files if r.member == "data.csv")
    assert len(parts) > 5 and parts == list(range(len(parts))) and [r.part for r in files if r.member == "small.csv"] == [0]
    assert all(r.length < 21_000 for r in files)
    assert {(r.member, r.landed_bytes) for r in report} == {(r.member, r.landed_bytes) for r in landed_keys(spark, f"{tmp}/land").collect()}
    read = lambda p: spark.read.option("header", True).option("multiLine", True).csv(p)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    want = rows(read(whole))
    got = read([r.path for r in files if r.member == "data.csv"])
    assert len(want) == 3000 and rows(got) == want
    assert spark.createDataFrame(files).count() and not land_archive_members(spark, listed, f"{tmp}/land", multi_line=True, part_bytes=20_000).count()


def test_parts_read_as_the_whole_for_odd_quotes(spark, tmp):
    """Doubled quotes, quotes in plain cells, unclosed and empty cells: Spark reads the parts as the whole."""
    rng = random.Random(6)
    cells = ['plain', '5" pipe', '"a, b"', '"two\nlines"', '"doubled ""quote"" here"', '"esc \\" aped\n"', '""', '', ' "spaced"', '"end\\\\"', "it's"]
    lines = ["k,a,b"] + [f"{i},{rng.choice(cells)},{rng.choice(cells)}" for i in range(2000)]
    text = "\n".join(lines).encode()
    with open(f"{tmp}/whole.csv", "wb") as f:
        f.write(text)
    parts = parts_of(text, 1000, 5000)
    for i, p in enumerate(parts):
        with open(f"{tmp}/part{i}.csv", "wb") as f:
            f.write(p)
    read = lambda p: sorted((tuple(r) for r in spark.read.option("header", True).option("multiLine", True).csv(p).collect()), key=str)
    assert len(parts) > 8 and read([f"{tmp}/part{i}.csv" for i in range(len(parts))]) == read(f"{tmp}/whole.csv")


def test_a_member_counts_as_landed_only_with_all_parts(spark, tmp, monkeypatch):
    import os

    os.makedirs(f"{tmp}/z")
    big_zip(f"{tmp}/z/a.zip", 400)
    from quayside.operators import land

    real, moved = fsutil.StagedFile.publish, []

    def publish(self):
        moved.append(self.target)
        if len(moved) == 3:
            raise OSError("no more room")
        real(self)

    monkeypatch.setattr(fsutil.StagedFile, "publish", publish)
    with zipfile.ZipFile(f"{tmp}/z/a.zip") as z, z.open("data.csv") as src, pytest.raises(OSError, match="room"):
        land._write_member(f"{tmp}/land/dataset=d/year=1/month=01/archive=a/data.csv", land._pieces(src.read, "utf-8"), 5_000)
    assert landed_keys(spark, f"{tmp}/land").count() == 0 and not [f for f in os.listdir(f"{tmp}/land/dataset=d/year=1/month=01/archive=a") if f.endswith(".tmp")]


def test_whole_run_with_parts(spark, tmp, monkeypatch):
    import json
    import os

    from quayside.operators import land

    monkeypatch.setattr(land.land_archive_members, "__defaults__", (None, "UTF-8", False, 20_000))
    os.makedirs(f"{tmp}/arc")
    big_zip(f"{tmp}/arc/s.zip", 2000)
    with open(f"{tmp}/catalog.json", "w") as f:
        json.dump({"mappings": [{"url_pattern": "https://h/s.zip", "table_name": "s", "parameters": [], "landing_path": "s", "comment": "", "types": {"n": "string"}}]}, f)
    out = run_load(spark, f"{tmp}/catalog.json", f"{tmp}/arc", f"{tmp}/root", start_year=2024, end_year=2024, as_of="2024-05-01 00:00:00",
                   options=IngestOptions(as_of="2024-05-01 00:00:00", multi_line=True))
    r, a = out["results"].first(), out["audit"].first()
    assert (r.status, r.total_rows, r.corrupt_rows) == ("success", 2001, 0) and (a.csv_count, a.success_count) == (2, 2)
    assert landing_manifest(spark, f"{tmp}/root/landing").count() == 5
    t = spark.read.parquet(f"{tmp}/root/tables/s")
    assert dict(t.dtypes)["n"] == "string" and t.where("note_long LIKE '%\n%'").count() > 1000
