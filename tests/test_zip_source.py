import hashlib
import io
import random
import zipfile

from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from quayside.sources import archives, zip_source
from quayside.sources.archives import scan_archives
from quayside.sources.zip_source import Chunk, chunks, holds, zip_members


def write_zip(path, members, compression=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", compression) as z:
        for name, data in members:
            z.writestr(zipfile.ZipInfo(name) if name.endswith("/") else name, data)


def sample(folder):
    import os

    os.makedirs(f"{folder}/sub/_hidden")
    write_zip(f"{folder}/a.zip", [("d/", b""), ("d/one.CSV", b"a,b\n1,2\n"), ("two.csv", b"x"), ("notes", b"n" * 1000), ("v.1.txt", b"")])
    write_zip(f"{folder}/sub/b.zip", [("two.csv", "é".encode())])
    write_zip(f"{folder}/sub/_hidden/c.zip", [("no.csv", b"")])
    with open(f"{folder}/broken.zip", "wb") as f:
        f.write(b"this is not a zip file")
    with open(f"{folder}/other.dat", "wb") as f:
        f.write(b"")


def test_listing_and_content(spark, tmp):
    sample(f"{tmp}/z")
    rows = zip_members(spark, f"{tmp}/z", content=True, digest=True).collect()
    got = {(r.archive_path.rsplit("/", 1)[-1], r.member): r for r in rows}
    assert set(got) == {("a.zip", "d/one.CSV"), ("a.zip", "two.csv"), ("a.zip", "notes"), ("a.zip", "v.1.txt"), ("b.zip", "two.csv"), ("broken.zip", None)}
    r = got[("a.zip", "d/one.CSV")]
    assert (r.basename, r.extension, r.is_dir, r.size_bytes, bytes(r.content)) == ("one.CSV", "csv", False, 8, b"a,b\n1,2\n")
    assert got[("a.zip", "notes")].extension == "" and got[("a.zip", "v.1.txt")].extension == "txt"
    assert all(r.md5 == hashlib.md5(bytes(r.content)).hexdigest() for r in rows if r.member)
    assert "BadZipFile" in got[("broken.zip", None)].error
    plain = zip_members(spark, f"{tmp}/z", directories="true")
    assert "content" not in plain.columns and plain.where("is_dir").count() == 1
    assert zip_members(spark, f"{tmp}/z/a.zip").count() == 4
    assert spark.read.format("zip_members").option("glob", "b*.zip").load(f"{tmp}/z").count() == 2


def test_filters_are_pushed_and_exact(spark, tmp):
    sample(f"{tmp}/z")
    df = zip_members(spark, f"{tmp}/z", "extension = 'csv' AND size_bytes > 1", content=True)
    plan = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "EqualTo(extension,csv)" in plan and "GreaterThan(size_bytes,1)" in plan and "Filter (" not in plan
    assert sorted(r.member for r in df.collect()) == ["d/one.CSV", "two.csv"]
    every = [(r.archive_path, r.member, r.size_bytes, r.is_dir, r.error) for r in zip_members(spark, f"{tmp}/z").collect()]
    spark.createDataFrame(every, "archive_path string, member string, size_bytes long, is_dir boolean, error string").createOrReplaceTempView("known")
    for cond in ("member = 'two.csv'", "member <> 'two.csv'", "member IN ('notes', 'x')", "member IS NULL", "member LIKE 'd/%'", "member LIKE '%.csv'", "member LIKE '%o%'",
                 "NOT (member LIKE '%.csv')", "size_bytes >= 8", "size_bytes < 8 AND is_dir = false", "member <=> NULL", "member > 'm' OR size_bytes = 8", "error IS NULL", "lower(member) LIKE '%.csv'"):
        want = sorted(((r.archive_path, r.member) for r in spark.sql(f"SELECT * FROM known WHERE {cond}").collect()), key=str)
        assert sorted(((r.archive_path, r.member) for r in zip_members(spark, f"{tmp}/z", cond).collect()), key=str) == want, cond


def test_one_frame_filtered_in_several_ways(spark, tmp):
    """Later filters never reach the source, whose pushed filters belong to the loaded frame."""
    sample(f"{tmp}/z")
    df = zip_members(spark, f"{tmp}/z", "extension = 'csv'")
    one, two = df.where("member = 'two.csv'"), df.where("member = 'd/one.CSV'")
    assert sorted(r.member for r in one.union(two).union(df).collect()) == ["d/one.CSV", "d/one.CSV", "two.csv", "two.csv", "two.csv", "two.csv"]
    assert df.count() == 3 and zip_members(spark, f"{tmp}/z").count() == 6


def test_a_member_that_is_not_wanted_is_not_opened(tmp, monkeypatch):
    sample(f"{tmp}/z")
    opened = []
    real = zipfile.ZipFile.open
    monkeypatch.setattr(zipfile.ZipFile, "open", lambda self, m, *a, **k: opened.append(getattr(m, "filename", m)) or real(self, m, *a, **k))
    source = zip_source.ZipMembers({"path": f"{tmp}/z", "content": "true"})
    reader = source.reader(source.schema())
    left = list(reader.pushFilters([ds.EqualTo(("extension",), "txt"), ds.EqualTo(("error",), "x"), ds.Not(ds.In(("content",), (b"",)))]))
    assert len(left) == 2
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [r["member"] for r in rows] == ["v.1.txt"] and opened == ["v.1.txt"]


def test_null_logic():
    row = dict.fromkeys(["member", "size_bytes"])
    assert holds(ds.EqualTo(("member",), "x"), row) is None and holds(ds.Not(ds.EqualTo(("member",), "x")), row) is None
    assert holds(ds.EqualNullSafe(("member",), None), row) is True and holds(ds.Not(ds.IsNull(("member",))), row) is False


def test_chunks():
    assert chunks([], 10) == []
    assert chunks([("a", 4), ("b", 5), ("c", 25), ("d", 0)], 10) == [Chunk([("a", 4, 0, 4), ("b", 5, 0, 5)]), Chunk([("c", 25, 0, 10)]), Chunk([("c", 25, 10, 20)]), Chunk([("c", 25, 20, 25), ("d", 0, 0, 1)])]


def test_big_archive_is_read_in_ranges(spark, tmp):
    import os

    rng = random.Random(1)
    os.makedirs(f"{tmp}/z")
    members = [(f"m{i}.csv", rng.randbytes(3000)) for i in range(40)]
    write_zip(f"{tmp}/z/big.zip", members, zipfile.ZIP_STORED)
    df = zip_members(spark, f"{tmp}/z", content=True, chunkBytes="20000")
    parts = zip_members(spark, f"{tmp}/z", content=True, chunkBytes="20000").select("member", F.spark_partition_id().alias("p"))
    assert parts.select("p").distinct().count() == 6  # the last range has the directory alone
    assert sorted((r.member, bytes(r.content)) for r in df.collect()) == sorted(members)


def test_damaged_member(spark, tmp):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_STORED) as z:
        z.writestr("good.csv", b"good" * 100)
        z.writestr("bad.csv", b"BAAD" * 100)
    with open(f"{tmp}/x.zip", "wb") as f:
        f.write(buf.getvalue().replace(b"BAADBAAD", b"BAADBAAX", 1))
    rows = {r.member: r for r in zip_members(spark, tmp, content=True, digest=True).collect()}
    assert rows["good.csv"].error is None and rows["bad.csv"].content is None and "CRC" in rows["bad.csv"].error


def test_md5_of_many_pieces(spark, tmp, monkeypatch):
    """Archives and members of several pieces: the digest is that of the whole."""
    data = random.Random(2).randbytes(3 * archives.HASH_PIECE_BYTES + 12345)
    write_zip(f"{tmp}/big.zip", [("m.bin", data)], zipfile.ZIP_STORED)
    with open(f"{tmp}/big.zip", "rb") as f:
        whole = f.read()
    r = scan_archives(spark, tmp).first()
    assert (r.size_bytes, r.md5) == (len(whole), hashlib.md5(whole).hexdigest())
    assert zip_members(spark, tmp, digest=True).first().md5 == hashlib.md5(data).hexdigest()
    plan = scan_archives(spark, tmp)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    sizes = []
    assert archives.hash_pieces(io.BytesIO(whole).read, hashlib.md5(), lambda p: sizes.append(len(p))) == r.md5 and max(sizes) == archives.HASH_PIECE_BYTES and len(sizes) == 4
