import hashlib
import io
import json
import os
import zipfile

from pyspark.sql import functions as F

from quayside.operators.land import land_members, landed_keys
from quayside.sources.archives import archive_members, decode_members, is_csv, scan_archives
from quayside.sources.landing import landing_manifest


def make_zips(folder):
    os.makedirs(folder, exist_ok=True)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("dir/f.CSV", "a,b\n1,2\n")
        z.writestr("readme.txt", "hello")
        z.writestr(zipfile.ZipInfo("empty/"), b"")
        z.writestr("x/same.csv", "a\n1\n")
        z.writestr("y/same.csv", "a\n2\n")
        z.writestr("latin.csv", "name\ncaf\xe9\n".encode("latin-1"))
    good = buf.getvalue()
    with open(f"{folder}/good.zip", "wb") as f:
        f.write(good)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("notes.txt", "no csv here")
    with open(f"{folder}/nocsv.zip", "wb") as f:
        f.write(buf.getvalue())
    with open(f"{folder}/broken.zip", "wb") as f:
        f.write(b"this is not a zip file")
    return hashlib.md5(good).hexdigest()


def test_scan_with_md5(spark, tmp):
    md5 = make_zips(f"{tmp}/z")
    rows = {r.archive: r for r in scan_archives(spark, f"{tmp}/z").collect()}
    assert set(rows) == {"good.zip", "nocsv.zip", "broken.zip"}
    assert rows["good.zip"].md5 == md5
    assert rows["broken.zip"].size_bytes == len(b"this is not a zip file")


def test_member_listing(spark, tmp):
    make_zips(f"{tmp}/z")
    m = archive_members(scan_archives(spark, f"{tmp}/z", with_md5=False)).withColumn(
        "archive", F.regexp_extract("archive_path", r"[^/]*$", 0))
    rows = m.collect()
    good = sorted(r.member for r in rows if r.archive == "good.zip")
    assert good == ["dir/f.CSV", "latin.csv", "readme.txt", "x/same.csv", "y/same.csv"]  # no folder entry
    assert [r.basename for r in rows if r.member == "dir/f.CSV"] == ["f.CSV"]
    broken = [r for r in rows if r.archive == "broken.zip"]
    assert len(broken) == 1 and broken[0].member is None and "BadZipFile" in broken[0].error
    csv = m.where(is_csv("member")).where(F.col("archive") == "good.zip").count()
    assert csv == 4
    assert m.where(F.col("archive") == "nocsv.zip").where(is_csv("member")).count() == 0


def test_decode_and_land(spark, tmp):
    make_zips(f"{tmp}/z")
    members = archive_members(scan_archives(spark, f"{tmp}/z", with_md5=False), with_content=True)
    dec = decode_members(members.where(F.col("error").isNull() & is_csv("member")))
    valid = {r.member: r.is_valid for r in dec.collect()}
    assert valid == {"dir/f.CSV": True, "x/same.csv": True, "y/same.csv": True, "latin.csv": False}
    keyed = dec.select(F.lit("ds").alias("dataset"), F.lit(2024).alias("year"), F.lit(1).alias("month"),
                       "member", "text", "size_bytes")
    land = f"{tmp}/land"
    land_members(spark, keyed, land)
    landed = {r.member: r.landed_bytes for r in landed_keys(spark, land).collect()}
    assert set(landed) == {"dir/f.CSV", "x/same.csv", "y/same.csv"}  # same base name: no collision
    first_files = sorted(r.path for r in landing_manifest(spark, land).collect())
    land_members(spark, keyed, land)  # landed members are skipped: the stream would see new file names
    assert sorted(r.path for r in landing_manifest(spark, land).collect()) == first_files
    back = spark.read.option("header", True).option("recursiveFileLookup", True).csv(f"{land}/dataset=ds").where(F.input_file_name().endswith("y%252Fsame.csv"))
    assert [r.a for r in back.collect()] == ["2"]
    assert json.dumps(sorted(landed)) is not None


def test_big_archive_is_read_in_chunks_by_several_tasks(spark, tmp, monkeypatch):
    import quayside.sources.archives as arch

    os.makedirs(f"{tmp}/big")
    with zipfile.ZipFile(f"{tmp}/big/hot.zip", "w") as z:
        for i in range(200):
            z.writestr(f"part/{i:03d}.csv", "id,v\n" + "".join(f"{i},{j}\n" for j in range(50)))
    monkeypatch.setattr(arch, "READ_CHUNK_BYTES", 4096)  # ~14 members (of ~300 bytes) per chunk
    listing = archive_members(scan_archives(spark, f"{tmp}/big", with_md5=False))
    assert listing.select("read_chunk").distinct().count() >= 10
    members = archive_members(scan_archives(spark, f"{tmp}/big", with_md5=False), with_content=True,
                              read_partitions=8)
    tasks = members.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 1
    rows = members.select("member", "content").collect()
    assert len(rows) == 200
    assert all(r.content.decode().startswith("id,v\n") for r in rows)


def test_changed_member_is_reported_not_relanded(spark, tmp):
    from quayside.operators.land import changed_members

    def members(text):
        return spark.createDataFrame([("ds", 2024, 1, "a.csv", text, len(text))],
                                     "dataset string, year int, month int, member string, text string, size_bytes long")

    land = f"{tmp}/land"
    part = [("ds", 2024, 1)]
    land_members(spark, members("a\n1\n"), land, partitions=part)
    assert changed_members(spark, members("a\n1\n"), land, part).count() == 0
    ch = changed_members(spark, members("a\n2\n"), land, part).collect()
    assert [(r.member, r.new_md5 != r.landed_md5) for r in ch] == [("a.csv", True)]
    land_members(spark, members("a\n2\n"), land, partitions=part)  # skipped: still the first content
    assert [r.a for r in spark.read.option("header", True).option("recursiveFileLookup", True).csv(f"{land}/dataset=ds").collect()] == ["1"]


def test_many_small_members_are_chunked_by_count(spark, tmp):
    from quayside.sources.archives import READ_CHUNK_MEMBERS

    os.makedirs(f"{tmp}/small")
    n = 3 * READ_CHUNK_MEMBERS + 7
    with zipfile.ZipFile(f"{tmp}/small/many.zip", "w") as z:
        z.writestr(zipfile.ZipInfo("dir/"), b"")
        for i in range(n):
            z.writestr(f"m/{i:05d}.csv", f"id\n{i}\n")
    listing = archive_members(scan_archives(spark, f"{tmp}/small", with_md5=False))
    per_chunk = {r.read_chunk: r.n for r in listing.groupBy("read_chunk").agg(F.count("*").alias("n")).collect()}
    assert sorted(per_chunk) == [0, 1, 2, 3]
    assert max(per_chunk.values()) == READ_CHUNK_MEMBERS and sum(per_chunk.values()) == n
    got = archive_members(scan_archives(spark, f"{tmp}/small", with_md5=False), with_content=True, read_partitions=8)
    assert got.where(F.col("content").isNotNull()).count() == n


def test_land_from_listing_skips_landed_members_before_reading(spark, tmp):
    from quayside.operators.land import land_archive_members, landed_keys
    from quayside.sources.archives import read_members

    os.makedirs(f"{tmp}/z")
    with zipfile.ZipFile(f"{tmp}/z/a.zip", "w") as z:
        z.writestr("x/one.csv", "id,v\n1,a\n")
        z.writestr("y/one.csv", "id,v\n2,b\n")
        z.writestr("notes.txt", "not landed")
        z.writestr("bad.csv", b"id\n\xff\xfe\n")
    listing = archive_members(scan_archives(spark, f"{tmp}/z", with_md5=False)).where(is_csv("member"))
    listed = listing.select("archive_path", "member", "read_chunk", F.lit("ds").alias("dataset"),
                            F.lit(2024).alias("year"), F.lit(None).cast("int").alias("month"))
    # Carried key columns keep their types (a NULL month stays a NULL int).
    got = read_members(listed).select("member", "dataset", "year", "month").orderBy("member").collect()
    assert [(r.member, r.dataset, r.year, r.month) for r in got] == [
        ("bad.csv", "ds", 2024, None), ("x/one.csv", "ds", 2024, None), ("y/one.csv", "ds", 2024, None)]
    land = f"{tmp}/land"
    part = [("ds", 2024, None)]
    land_archive_members(spark, listed.unionByName(listed), land, partitions=part)  # duplicates land once
    first = {(r.member, r.landed_bytes) for r in landed_keys(spark, land).collect()}
    assert first == {("x/one.csv", 10), ("y/one.csv", 10)}  # + the writer's newline; bad.csv not written
    land_archive_members(spark, listed, land, partitions=part)
    assert landed_keys(spark, land).count() == 2
    report = land_archive_members(spark, listed, land, partitions=part).collect()
    assert [(r.member, r.landed_bytes, r.error.split(":")[0]) for r in report] == [("bad.csv", None, "UnicodeDecodeError")]


def test_archive_landing_shuffles_no_content(spark, tmp):
    """Exchanges carry listing rows only: none sits above the task that reads content."""
    from quayside.operators.land import landing_tasks

    os.makedirs(f"{tmp}/z")
    with zipfile.ZipFile(f"{tmp}/z/a.zip", "w") as z:
        for i in range(20):
            z.writestr(f"m/{i}.csv", f"id\n{i}\n")
    listed = archive_members(scan_archives(spark, f"{tmp}/z", with_md5=False)).select(
        "archive_path", "member", "size_bytes", F.lit("ds").alias("dataset"), F.lit(2024).alias("year"),
        F.lit(1).alias("month"), F.lit("a.zip").alias("archive"))
    plan = landing_tasks(spark, listed.select("archive_path", "size_bytes", "dataset", "year", "month", "archive", "member"), f"{tmp}/land")
    text = plan._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    first_reader = next(i for i, ln in enumerate(lines) if "MapInPandas" in ln)
    assert "landed_bytes" in lines[first_reader]  # the top-most Python node lands the content
    assert all("Exchange" not in ln for ln in lines[:first_reader])
    assert plan.count() == 20


def test_listing_streams_out_in_row_batches(spark, tmp, monkeypatch):
    import quayside.sources.archives as arch

    monkeypatch.setattr(arch, "MEMBER_BATCH_ROWS", 7)
    os.makedirs(f"{tmp}/z")
    with zipfile.ZipFile(f"{tmp}/z/a.zip", "w") as z:
        for i in range(50):
            z.writestr(f"m/{i}.csv", f"id\n{i}\n")
    listing = archive_members(scan_archives(spark, f"{tmp}/z", with_md5=False))
    assert sorted(r.member for r in listing.collect()) == sorted(f"m/{i}.csv" for i in range(50))
    got = archive_members(scan_archives(spark, f"{tmp}/z", with_md5=False), with_content=True, read_partitions=2)
    assert got.where(F.col("content").isNotNull()).count() == 50


def test_big_members_are_streamed_to_their_landing_file(spark, tmp, monkeypatch):
    import quayside.operators.land as L

    monkeypatch.setattr(L, "PIECE_BYTES", 64)  # many pieces; a multi-byte letter crosses a piece edge
    big = "id,name\n" + "".join(f"{i},Zoë {i}\n" for i in range(300))
    os.makedirs(f"{tmp}/z")
    with zipfile.ZipFile(f"{tmp}/z/a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("big/x.csv", big)
        z.writestr("big/bad.csv", big.encode() + b"\xff\xfe\n" + big.encode())
        z.writestr("small.csv", "id,name\n1,a\n")
    listing = archive_members(scan_archives(spark, f"{tmp}/z", with_md5=False)).where(is_csv("member"))
    listed = listing.select("archive_path", "member", "read_chunk", "size_bytes", F.lit("ds").alias("dataset"),
                            F.lit(2024).alias("year"), F.lit(3).alias("month"))
    land = f"{tmp}/land"
    for _ in range(2):  # the second landing finds both members landed
        L.land_archive_members(spark, listed, land, partitions=[("ds", 2024, 3)])
    got = {(r.member, r.landed_bytes) for r in landed_keys(spark, land).collect()}
    assert got == {("big/x.csv", len(big.encode()) + 1), ("small.csv", 13)}
    file = f"{land}/dataset=ds/year=2024/month=03/archive=a.zip/big%2Fx.csv"
    streamed = spark.read.format("binaryFile").load(file)
    assert [r.content for r in streamed.select("content").collect()] == [big.encode() + b"\n"]
    rows = spark.read.option("header", True).csv(file)
    assert rows.count() == 300 and rows.where(F.col("name") == "Zoë 7").count() == 1


def test_same_member_from_two_archives_lands_twice(spark, tmp):
    from quayside.operators.land import land_archive_members

    os.makedirs(f"{tmp}/z")
    for name, body in [("a.zip", "id\n1\n"), ("b.zip", "id\n22\n")]:
        with zipfile.ZipFile(f"{tmp}/z/{name}", "w") as z:
            z.writestr("x.csv", body)
    listed = archive_members(scan_archives(spark, f"{tmp}/z", with_md5=False)).select(
        "archive_path", "member", "read_chunk", "size_bytes", F.lit("ds").alias("dataset"),
        F.lit(None).cast("int").alias("year"), F.lit(None).cast("int").alias("month"))
    land_archive_members(spark, listed, f"{tmp}/land", partitions=[("ds", None, None)])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{tmp}/land").select("content").collect()
    assert sorted(r.content for r in files) == [b"id\n1\n\n", b"id\n22\n\n"]


def test_null_and_empty_datasets_land_alike(spark, tmp):
    from quayside.operators.land import land_archive_members

    os.makedirs(f"{tmp}/z")
    with zipfile.ZipFile(f"{tmp}/z/a.zip", "w") as z:
        z.writestr("_hidden/.x y+z.csv", "id\n1\n")
    for dataset in (None, ""):
        listed = archive_members(scan_archives(spark, f"{tmp}/z", with_md5=False)).select(
            "archive_path", "member", F.lit(dataset).cast("string").alias("dataset"), F.lit(2024).alias("year"), F.lit(1).alias("month"))
        land = f"{tmp}/land{dataset is None}"
        for _ in range(2):
            land_archive_members(spark, listed, land, partitions=[(dataset, 2024, 1)])
        assert [(r.dataset, r.archive, r.member, r.landed_bytes) for r in landed_keys(spark, land).collect()] == [(None, "a.zip", "_hidden/.x y+z.csv", 6)]


def test_bad_bytes_in_another_charset_are_null(spark):
    df = spark.createDataFrame([(b"caf\xe9",), (b"\x81",), (None,)], "content binary")
    got = decode_members(df, "cp1252").collect()
    assert [(r.is_valid, r.text) for r in got] == [(True, "caf\u00e9"), (False, None), (None, None)]


def test_landed_files_are_listed_by_tasks(spark, tmp):
    """The manifest holds every landed file, and no file index of the driver lists them."""
    rows = [(d, y, m, a, f"x/{k}.csv", "t") for d in ("p", None) for y in (2023, None) for m in (1, 12) for a in ("a", "b c") for k in range(3)]
    members = spark.createDataFrame(rows, "dataset string, year int, month int, archive string, member string, text string")
    assert land_members(spark, members, f"{tmp}/land").count() == 48
    os.makedirs(f"{tmp}/land/dataset=p/year=2023/month=01/archive=_=d")
    open(f"{tmp}/land/dataset=p/year=2023/month=01/archive=a/.hidden.tmp", "w").close()
    whole = landing_manifest(spark, f"{tmp}/land")
    assert {(r.dataset, r.year, r.month, r.archive, r.member) for r in whole.collect()} == {r[:5] for r in rows}
    spark_names = {r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{tmp}/land").select("path").collect()}
    assert {r.path for r in whole.collect()} == spark_names and whole.where("modificationTime > TIMESTAMP '2020-01-01' AND length = 2 AND part = 0").count() == 48
    some = landing_manifest(spark, f"{tmp}/land", [("p", 2023, 1), ("p", 1999, 1)])
    assert some.count() == 6 and landing_manifest(spark, f"{tmp}/none").count() == 0
    assert not whole.inputFiles() and "FileScan" not in whole._jdf.queryExecution().toString()
    assert land_members(spark, members, f"{tmp}/land").count() == 0
