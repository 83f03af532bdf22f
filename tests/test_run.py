import io
import json
import os
import zipfile

from quayside.plans.run import run_load
from quayside.sources.landing import escape_partition_value


def zip_bytes(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)
    return buf.getvalue()


def test_whole_run_and_rerun(spark, tmp):
    catalog = {"mappings": [
        {"url_pattern": "https://h/files/harvest-{month_name}-{year}.zip", "table_name": "harvest",
         "parameters": ["month_name", "year"], "landing_path": "harvest", "comment": "Monthly harvest"},
        {"url_pattern": "https://h/files/ledger-{year}.zip", "table_name": "ledger",
         "parameters": ["year"], "landing_path": "ledger", "comment": "Yearly ledger"},
        {"url_pattern": "https://h/files/directory.zip", "table_name": "directory",
         "parameters": [], "landing_path": "directory", "comment": "Static directory"},
    ]}
    with open(f"{tmp}/catalog.json", "w") as f:
        json.dump(catalog, f)
    arc = f"{tmp}/archives"
    os.makedirs(arc)
    files = {
        "harvest-january-2024.zip": {"data/Harvest Jan.csv": "Parcel ID,Crates\nH1,10\nH2,20\n",
                                    "readme.txt": "x"},
        "harvest-february-2024.zip": {"Harvest Feb.csv": "Parcel ID,Crates,Crop Kind\nH1,11,MA\n"},
        "ledger-2024.zip": {"notes.txt": "no csv"},
        "directory.zip": b"not a zip",
    }
    for name, members in files.items():
        with open(f"{arc}/{name}", "wb") as f:
            f.write(members if isinstance(members, bytes) else zip_bytes(members))

    out = run_load(spark, f"{tmp}/catalog.json", arc, f"{tmp}/root", mode="backfill", start_year=2024,
                   end_year=2024, as_of="2024-03-05 00:00:00")
    audit = {(r.url.rsplit("/", 1)[-1]): r for r in out["audit"].collect()}
    assert len(audit) == 12 + 1 + 1
    assert audit["harvest-january-2024.zip"].download_status == "success"
    assert audit["harvest-january-2024.zip"].files_in_zip == ["Harvest Jan.csv", "readme.txt"]
    assert audit["harvest-january-2024.zip"].csv_count == 1
    assert audit["harvest-march-2024.zip"].download_status == "not_found"
    assert audit["ledger-2024.zip"].download_status == "no_csv_found"
    assert audit["directory.zip"].download_status == "bad_archive"
    assert [r.table_name for r in out["selected"].collect()] == ["harvest"]
    res = out["results"].first()
    assert (res.status, res.table_name, res.total_rows) == ("success", "harvest", 3)
    s = out["summary"].first()
    assert (s.processing.tables_processed, s.processing.successful, s.processing.total_rows_loaded) == (1, 1, 3)
    t = spark.read.parquet(f"{tmp}/root/tables/harvest")
    assert sorted((r.parcel_id, r.crates, r.crop_kind) for r in t.collect()) == [
        ("H1", 10, None), ("H1", 11, "MA"), ("H2", 20, None)]

    again = run_load(spark, f"{tmp}/catalog.json", arc, f"{tmp}/root", mode="backfill", start_year=2024,
                     end_year=2024, as_of="2024-03-05 00:00:01")
    r2 = again["results"].first()
    assert (r2.total_rows, r2.rows_added) == (3, 0)


def test_escape_partition_value():
    assert escape_partition_value("a/b c=d") == "a%2Fb c%3Dd"


def test_incremental_run_takes_previous_month(spark, tmp):
    catalog = {"mappings": [
        {"url_pattern": "https://h/m-{month_name}-{year}.zip", "table_name": "m", "parameters": ["month_name", "year"],
         "landing_path": "m", "comment": ""},
        {"url_pattern": "https://h/y-{year}.zip", "table_name": "y", "parameters": ["year"], "landing_path": "y",
         "comment": ""}]}
    with open(f"{tmp}/catalog.json", "w") as f:
        json.dump(catalog, f)
    os.makedirs(f"{tmp}/arc")
    with open(f"{tmp}/arc/m-december-2023.zip", "wb") as f:
        f.write(zip_bytes({"m.csv": "a\n1\n"}))
    out = run_load(spark, f"{tmp}/catalog.json", f"{tmp}/arc", f"{tmp}/root", mode="incremental",
                   as_of="2024-01-10 08:00:00")
    urls = sorted(r.url for r in out["tasks"].collect())
    assert urls == ["https://h/m-december-2023.zip", "https://h/y-2023.zip"]
    assert out["results"].first().total_rows == 1


def test_fetch_log_statuses_and_registration(spark, tmp):
    catalog = {"mappings": [
        {"url_pattern": "https://h/d-{year}.zip", "table_name": "d", "parameters": ["year"], "landing_path": "d",
         "comment": "Dataset's comment"}]}
    with open(f"{tmp}/catalog.json", "w") as f:
        json.dump(catalog, f)
    os.makedirs(f"{tmp}/arc")
    with open(f"{tmp}/arc/d-2022.zip", "wb") as f:
        f.write(zip_bytes({"d.csv": "a\n1\n2\n"}))
    log = spark.createDataFrame([("https://h/d-2021.zip", 404, None), ("https://h/d-2020.zip", 503, None),
                                 ("https://h/d-2023.zip", None, "ReadTimeout: 300 s"),
                                 ("https://h/d-2022.zip", 200, None)], "url string, http_code int, error string")
    out = run_load(spark, f"{tmp}/catalog.json", f"{tmp}/arc", f"{tmp}/root", start_year=2020, end_year=2024,
                   as_of="2025-01-01 00:00:00", fetch_log=log, register_tables=True, schema_name="quayside_test_db")
    st = {r.year: r.download_status for r in out["audit"].collect()}
    assert st == {2020: "http_error_503", 2021: "not_found", 2022: "success", 2023: "error: ReadTimeout: 300 s",
                  2024: "not_found"}
    assert spark.table("quayside_test_db.d").count() == 2
    from quayside.streaming.tables import table_comment
    assert table_comment(spark, "quayside_test_db.d") == "Dataset's comment"


def test_run_reports_changed_members(spark, tmp):
    catalog = {"mappings": [{"url_pattern": "https://h/s.zip", "table_name": "s", "parameters": [],
                             "landing_path": "s", "comment": ""}]}
    with open(f"{tmp}/catalog.json", "w") as f:
        json.dump(catalog, f)
    os.makedirs(f"{tmp}/arc")
    with open(f"{tmp}/arc/s.zip", "wb") as f:
        f.write(zip_bytes({"s.csv": "a\n1\n"}))
    first = run_load(spark, f"{tmp}/catalog.json", f"{tmp}/arc", f"{tmp}/root", start_year=2024, end_year=2024,
                     as_of="2024-05-01 00:00:00", report_changes=True)
    assert first["changed"].count() == 0
    with open(f"{tmp}/arc/s.zip", "wb") as f:
        f.write(zip_bytes({"s.csv": "a\n2\n"}))
    again = run_load(spark, f"{tmp}/catalog.json", f"{tmp}/arc", f"{tmp}/root", start_year=2024, end_year=2024,
                     as_of="2024-05-01 00:00:01", report_changes=True)
    assert [r.member for r in again["changed"].collect()] == ["s.csv"]
    assert again["results"].first().total_rows == 1


def test_several_tables_ingested_in_parallel(spark, tmp):
    names = ["alpha", "beta", "gamma", "delta"]
    catalog = {"mappings": [{"url_pattern": f"https://h/{n}-{{year}}.zip", "table_name": f"t_{n}",
                             "parameters": ["year"], "landing_path": n, "comment": n} for n in names]}
    with open(f"{tmp}/catalog.json", "w") as f:
        json.dump(catalog, f)
    os.makedirs(f"{tmp}/arc")
    for k, n in enumerate(names):
        rows = "".join(f"{i},{n}\n" for i in range(10 * (k + 1)))
        with open(f"{tmp}/arc/{n}-2024.zip", "wb") as f:
            f.write(zip_bytes({f"{n}.csv": "id,name\n" + rows}))
    out = run_load(spark, f"{tmp}/catalog.json", f"{tmp}/arc", f"{tmp}/root", start_year=2024, end_year=2024,
                   as_of="2024-07-01 00:00:00", parallel=4)
    got = {r.table_name: (r.status, r.total_rows) for r in out["results"].collect()}
    assert got == {f"t_{n}": ("success", 10 * (k + 1)) for k, n in enumerate(names)}
    for k, n in enumerate(names):
        t = spark.read.parquet(f"{tmp}/root/tables/t_{n}")
        assert t.count() == 10 * (k + 1) and {r.name for r in t.select("name").distinct().collect()} == {n}


def test_member_audit_rows(spark, tmp):
    from quayside.operators.audit import read_audit_members

    catalog = {"mappings": [{"url_pattern": "https://h/s.zip", "table_name": "s", "parameters": [],
                             "landing_path": "s", "comment": ""}]}
    with open(f"{tmp}/catalog.json", "w") as f:
        json.dump(catalog, f)
    os.makedirs(f"{tmp}/arc")
    with open(f"{tmp}/arc/s.zip", "wb") as f:
        f.write(zip_bytes({"a/s.csv": "a\n1\n", "b/s.csv": "a\n2\n", "r.txt": "x"}))
    out = run_load(spark, f"{tmp}/catalog.json", f"{tmp}/arc", f"{tmp}/root", start_year=2024, end_year=2024,
                   as_of="2024-05-01 00:00:00")
    m = sorted((r.member_path, r.is_csv, r.written) for r in read_audit_members(spark, f"{tmp}/root/audit_members").collect())
    assert m == [("a/s.csv", True, True), ("b/s.csv", True, True), ("r.txt", False, False)]
    a = out["audit"].first()
    assert (a.download_status, a.csv_count, a.success_count) == ("success", 2, 2)
    assert out["results"].first().total_rows == 2


def test_runs_of_one_time_and_equal_names_stay_apart(spark, tmp):
    """Two URLs with equal base names, a shared landing path, equal member names, and a second run with
    the same ``as_of``."""
    catalog = {"mappings": [{"url_pattern": f"https://h/{n}/{{year}}.zip", "table_name": "t", "parameters": ["year"],
                             "landing_path": "shared", "comment": ""} for n in "ab"]}
    with open(f"{tmp}/catalog.json", "w") as f:
        json.dump(catalog, f)
    for k, n in enumerate("ab"):
        os.makedirs(f"{tmp}/arc/{n}")
        with open(f"{tmp}/arc/{n}/2024.zip", "wb") as f:
            f.write(zip_bytes({"data.csv": f"id,src\n{k},{n}\n"}))
    for added in (2, 0):
        out = run_load(spark, f"{tmp}/catalog.json", f"{tmp}/arc", f"{tmp}/root", start_year=2024, end_year=2024,
                       as_of="2024-05-01 00:00:00")
        audit = sorted((r.url, r.download_status, r.csv_count, r.success_count, r.files_in_zip) for r in out["audit"].collect())
        assert audit == [(f"https://h/{n}/2024.zip", "success", 1, 1, ["data.csv"]) for n in "ab"]
        r = out["results"].first()
        assert (r.status, r.total_rows, r.rows_added) == ("success", 2, added)
    assert sorted(r.src for r in spark.read.parquet(f"{tmp}/root/tables/t").collect()) == ["a", "b"]


def test_latin1_members(spark, tmp):
    with open(f"{tmp}/catalog.json", "w") as f:
        json.dump({"mappings": [{"url_pattern": "https://h/s.zip", "table_name": "s", "parameters": [], "landing_path": "s", "comment": ""}]}, f)
    os.makedirs(f"{tmp}/arc")
    with open(f"{tmp}/arc/s.zip", "wb") as f:
        f.write(zip_bytes({"s.csv": "a\nBogot\u00e1\n".encode("latin-1")}))
    run_load(spark, f"{tmp}/catalog.json", f"{tmp}/arc", f"{tmp}/root", start_year=2024, end_year=2024, as_of="2024-05-01 00:00:00", charset="latin-1")
    assert spark.read.parquet(f"{tmp}/root/tables/s").first().a == "Bogot\u00e1"
