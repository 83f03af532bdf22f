import os
import time

import pytest

from quayside.streaming import schema_log
from quayside.streaming.ingest import IngestOptions, ingest_table, make_batch_function, read_headers, read_table

AS_OF = "2024-06-01 00:00:00"


def put(root, rel, text, mtime=None):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    if mtime is not None:
        os.utime(path, (mtime, mtime))
    return path


def run(spark, tmp, **kw):
    opts = IngestOptions(as_of=AS_OF, **kw)
    return ingest_table(spark, f"{tmp}/land", f"{tmp}/table", f"{tmp}/ckpt", "t", opts).first()


def table(spark, tmp):
    return read_table(spark, f"{tmp}/table", f"{tmp}/ckpt")


def test_no_source_data(spark, tmp):
    r = run(spark, tmp)
    assert (r.status, r.total_rows) == ("no_source_data", 0)


def test_two_headers_bind_by_name_and_evolve(spark, tmp):
    put(tmp, "land/year=2024/month=01/a.csv", "Parcel ID,N\nH1,1\nH2,2\n")
    put(tmp, "land/year=2024/month=02/b c.csv", "Parcel ID,M,N\nH3,x,3\n")
    r = run(spark, tmp)
    assert (r.status, r.total_rows, r.rows_added) == ("success", 3, 3)
    rows = {x.parcel_id: (x.n, x.m, x._year, x._month) for x in table(spark, tmp).collect()}
    assert rows == {"H1": (1, None, 2024, 1), "H2": (2, None, 2024, 1), "H3": (3, "x", 2024, 2)}
    assert schema_log.latest_columns(spark, f"{tmp}/ckpt/schema") == [("parcel_id", "string"), ("n", "int"),
                                                                      ("m", "string")] or \
        schema_log.latest_columns(spark, f"{tmp}/ckpt/schema") == [("parcel_id", "string"), ("m", "string"),
                                                                   ("n", "int")]


def test_rerun_loads_nothing_and_new_file_is_incremental(spark, tmp):
    put(tmp, "land/year=2024/month=01/a.csv", "A,B\n1,2\n3,4\n")
    assert run(spark, tmp).total_rows == 2
    r = run(spark, tmp)
    assert (r.total_rows, r.rows_added, r.batches) == (2, 0, 0)
    put(tmp, "land/year=2024/month=02/b.csv", "A,B,C\n5,6,7\n")
    r = run(spark, tmp)
    assert (r.total_rows, r.rows_added) == (3, 1)
    t = table(spark, tmp)
    assert sorted((x.a, x.c) for x in t.collect()) == [(1, None), (3, None), (5, 7)]


def test_several_batches(spark, tmp):
    for i in range(5):
        put(tmp, f"land/year=2024/month=0{i + 1}/f.csv", f"A\n{i}\n")
    r = run(spark, tmp, max_files_per_trigger=2)
    assert (r.total_rows, r.batches) == (5, 3)
    assert table(spark, tmp).select("_batch_id").distinct().count() == 3


def test_replayed_batch_overwrites_itself(spark, tmp):
    put(tmp, "land/year=2024/month=01/a.csv", "A,B\n1,2\n3,4\n")
    fn = make_batch_function(spark, f"{tmp}/table", f"{tmp}/ckpt/schema", IngestOptions(as_of=AS_OF))
    batch = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{tmp}/land").select("path", "length")
    fn(batch, 0)
    fn(batch, 0)  # a crash between write and commit replays the same batch id
    assert spark.read.parquet(f"{tmp}/table").count() == 2


def test_corrupt_rows_are_kept(spark, tmp):
    put(tmp, "land/year=2024/month=01/a.csv", "id,qty\n1,5\n2,7\n")
    run(spark, tmp)
    put(tmp, "land/year=2024/month=02/b.csv", "id,qty\n3,lots\n4\n5,9\n")
    r = run(spark, tmp)
    assert (r.rows_added, r.corrupt_rows, r.empty_files) == (3, 2, 0)
    rows = {x.id: (x.qty, x._corrupt_record) for x in table(spark, tmp).collect()}
    assert rows[1] == (5, None) and rows[5] == (9, None)
    assert rows[3] == (None, "3,lots")
    assert rows[4][0] is None


def test_type_drift_widens_int(spark, tmp):
    put(tmp, "land/year=2024/month=01/a.csv", "k,v\n1,10\n")
    run(spark, tmp)
    put(tmp, "land/year=2024/month=02/b.csv", "k,v\n2,9999999999\n")
    run(spark, tmp)
    assert dict(schema_log.latest_columns(spark, f"{tmp}/ckpt/schema"))["v"] == "bigint"
    put(tmp, "land/year=2024/month=03/c.csv", "k,v\n3,2.5\n4,text\n")
    run(spark, tmp)
    assert dict(schema_log.latest_columns(spark, f"{tmp}/ckpt/schema"))["v"] == "bigint"  # text among them
    put(tmp, "land/year=2024/month=04/d.csv", "k,v\n5,2.5\n")
    assert run(spark, tmp).corrupt_rows == 0
    assert dict(schema_log.latest_columns(spark, f"{tmp}/ckpt/schema"))["v"] == "double"
    rows = {x.k: (x.v, x._corrupt_record is not None) for x in table(spark, tmp).collect()}
    assert rows == {1: (10.0, False), 2: (9999999999.0, False), 3: (None, True), 4: (None, True), 5: (2.5, False)}


def test_type_override_keeps_leading_zeros(spark, tmp):
    put(tmp, "land/year=2024/month=01/a.csv", "zip,n\n01234,1\n")
    run(spark, tmp, type_overrides={"zip": "string"})
    assert table(spark, tmp).first().zip == "01234"


def test_quoted_comma_and_newline(spark, tmp):
    put(tmp, "land/year=2024/month=01/a.csv", 'a,b\n"x, y","line1\nline2"\n')
    run(spark, tmp, multi_line=True)
    r = table(spark, tmp).first()
    assert (r.a, r.b) == ("x, y", "line1\nline2")


def test_data_columns_year_month_survive(spark, tmp):
    put(tmp, "land/year=2024/month=01/a.csv", "Year,Month,v\n1999,7,1\n")
    run(spark, tmp)
    r = table(spark, tmp).first()
    assert (r.year, r.month, r._year, r._month) == (1999, 7, 2024, 1)


def test_lineage_columns(spark, tmp):
    put(tmp, "land/year=2024/month=01/a.csv", "a\n1\n")
    run(spark, tmp)
    r = table(spark, tmp).first()
    assert str(r._load_timestamp) == "2024-06-01 00:00:00"
    assert r._processing_date == "2024-06-01"
    assert r._source_file.endswith("/land/year=2024/month=01/a.csv")


def test_late_file_with_old_mtime_is_read(spark, tmp):
    put(tmp, "land/year=2024/month=01/a.csv", "a\n1\n")
    run(spark, tmp)
    put(tmp, "land/year=2020/month=01/old.csv", "a\n2\n", mtime=time.time() - 40 * 86400)
    assert run(spark, tmp).total_rows == 2


def test_new_checkpoint_starts_table_anew(spark, tmp):
    put(tmp, "land/year=2024/month=01/a.csv", "a\n1\n")
    run(spark, tmp)
    again = (spark, f"{tmp}/land", f"{tmp}/table", f"{tmp}/ckpt2", "t")
    r = ingest_table(*again, IngestOptions(as_of=AS_OF)).first()  # nothing is deleted by default
    assert r.status == "failed" and table(spark, tmp).count() == 1
    r = ingest_table(*again, IngestOptions(as_of=AS_OF, on_new_checkpoint="truncate")).first()
    assert r.status == "success" and spark.read.parquet(f"{tmp}/table").count() == 1


def test_register_loaded_table_keeps_comment_and_widens(spark, tmp):
    from quayside.streaming.tables import register_loaded_table, table_comment

    put(tmp, "land/year=2024/month=01/a.csv", "k,v\n1,10\n")
    run(spark, tmp)
    register_loaded_table(spark, "quayside_test_loaded", f"{tmp}/table", f"{tmp}/ckpt", "Loaded's data")
    assert spark.table("quayside_test_loaded").count() == 1
    put(tmp, "land/year=2024/month=02/b.csv", "k,v,w\n2,9999999999,x\n")
    run(spark, tmp)
    register_loaded_table(spark, "quayside_test_loaded", f"{tmp}/table", f"{tmp}/ckpt", "ignored")
    t = spark.table("quayside_test_loaded")
    assert dict(t.dtypes)["v"] == "bigint" and "w" in t.columns
    assert sorted(r.v for r in t.collect()) == [10, 9999999999]
    assert table_comment(spark, "quayside_test_loaded") == "Loaded's data"
    spark.sql("DROP TABLE quayside_test_loaded")


def test_file_names_with_glob_characters(spark, tmp):
    put(tmp, "land/year=2024/month=01/a[1].csv", "a\n1\n")
    put(tmp, "land/year=2024/month=01/a1.csv", "a\n2\n")
    put(tmp, "land/year=2024/month=01/b{x,y}*.csv", "a\n3\n")
    r = run(spark, tmp)
    assert (r.status, r.total_rows) == ("success", 3)
    assert sorted(x.a for x in table(spark, tmp).collect()) == [1, 2, 3]


def test_latin1_files_with_encoding_option(spark, tmp):
    path = os.path.join(tmp, "land/year=2024/month=01/l.csv")
    os.makedirs(os.path.dirname(path))
    with open(path, "wb") as f:
        f.write("Año,Ciudad\n1,Bogotá\n".encode("latin-1"))
    r = run(spark, tmp, encoding="ISO-8859-1")
    assert r.total_rows == 1
    row = table(spark, tmp).first()
    assert (row.a_o, row.ciudad) == (1, "Bogotá")


def test_schema_log_versions_only_for_changing_batches(spark, tmp):
    put(tmp, "land/year=2024/month=01/a.csv", "Id,N\n1,1\n")
    put(tmp, "land/year=2024/month=02/b.csv", "Id,N\n2,2\n")
    put(tmp, "land/year=2024/month=03/c.csv", "Id,N\n3,3\n")
    r = run(spark, tmp, max_files_per_trigger=1)
    assert (r.status, r.batches, r.total_rows) == ("success", 3, 3)
    log = schema_log.read_log(spark, f"{tmp}/ckpt/schema")
    assert sorted({x.version for x in log.select("version").collect()}) == [0]
    put(tmp, "land/year=2024/month=04/d.csv", "Id,N,Extra\n4,4,x\n")
    put(tmp, "land/year=2024/month=05/e.csv", "Id,N\n5,5000000000\n")  # int -> bigint
    r = run(spark, tmp, max_files_per_trigger=1)
    assert (r.status, r.batches, r.total_rows) == ("success", 2, 5)
    log = schema_log.read_log(spark, f"{tmp}/ckpt/schema")  # a new listing
    assert sorted({x.version for x in log.select("version").collect()}) == [0, 3, 4]
    assert schema_log.latest_columns(spark, f"{tmp}/ckpt/schema") == [("id", "int"), ("n", "bigint"), ("extra", "string")]
    assert schema_log.latest_columns(spark, f"{tmp}/ckpt/schema", before=3) == [("id", "int"), ("n", "int")]
    rows = {(x.id, x.n, x.extra) for x in table(spark, tmp).collect()}
    assert rows == {(1, 1, None), (2, 2, None), (3, 3, None), (4, 4, "x"), (5, 5000000000, None)}


def test_dates_keep_their_times(spark, tmp):
    put(tmp, "land/year=2024/month=01/a.csv", "k,at\n1,2024-01-01\n")
    run(spark, tmp)
    assert dict(schema_log.latest_columns(spark, f"{tmp}/ckpt/schema"))["at"] == "date"
    put(tmp, "land/year=2024/month=02/b.csv", "k,at\n2,2024-01-02 10:00:00\n")
    run(spark, tmp)
    assert {x.k: str(x.at) for x in table(spark, tmp).collect()} == {1: "2024-01-01 00:00:00", 2: "2024-01-02 10:00:00"}


def test_long_header_blank_first_line_and_line_ends(spark, tmp):
    wide = ",".join(f"{'long_' * 60}{k}" for k in range(5_000))  # above 1 MB
    assert len(wide) > 1 << 20
    put(tmp, "land/year=2024/month=01/blank.csv", "\n\nA,B\n1,2\n")
    put(tmp, "land/year=2024/month=01/cr.csv", "A,B\r3,4\r")
    put(tmp, "land/year=2024/month=01/crlf.csv", "\r\nA,B\r\n5,6\r\n")
    r = run(spark, tmp)
    assert (r.status, r.total_rows) == ("success", 3)
    assert sorted((x.a, x.b) for x in table(spark, tmp).collect()) == [(1, 2), (3, 4), (5, 6)]
    path = put(tmp, "wide/w.csv", wide + "\n")
    names = read_headers(spark, [path], IngestOptions())[path]
    assert len(names) == 5_000 and names[-1].endswith("_4999")


def test_quoted_newline_in_header(spark, tmp):
    put(tmp, "land/year=2024/month=01/a.csv", '"a\nb",c\n1,2\n')
    assert run(spark, tmp, multi_line=True).total_rows == 1
    assert (table(spark, tmp).first().a_b, table(spark, tmp).first().c) == (1, 2)


def test_empty_files_are_counted_and_do_not_block(spark, tmp):
    put(tmp, "land/year=2024/month=01/a.csv", "\n")
    put(tmp, "land/year=2024/month=01/b.csv", "\r\n\n")
    put(tmp, "land/year=2024/month=01/c.csv", "")  # of no bytes: the file source does not list it
    r = run(spark, tmp)
    assert (r.status, r.total_rows, r.empty_files) == ("success", 0, 2)
    put(tmp, "land/year=2024/month=02/c.csv", "a\n1\n")
    r = run(spark, tmp)
    assert (r.status, r.total_rows, r.empty_files) == ("success", 1, 0)


def test_unreadable_file_fails_the_batch_and_is_tried_again(spark, tmp):
    put(tmp, "land/year=2024/month=01/a.csv", "a\n1\n")
    fn = make_batch_function(spark, f"{tmp}/table", f"{tmp}/ckpt/schema", IngestOptions(as_of=AS_OF))
    paths = [(f"file:{tmp}/land/year=2024/month=01/{n}", 4) for n in ("a.csv", "gone.csv")]
    with pytest.raises(Exception, match="gone.csv"):
        fn(spark.createDataFrame(paths, "path string, length long"), 0)
    assert not os.path.exists(f"{tmp}/table")
    bad = put(tmp, "land/year=2024/month=02/z.csv", "a\n2\n")
    r = run(spark, tmp, encoding="no-such-charset")
    assert r.status == "failed" and r.message and r.total_rows == 0
    assert (run(spark, tmp).status, run(spark, tmp).total_rows, os.path.exists(bad)) == ("success", 2, True)


def test_file_from_1980_is_read(spark, tmp):
    put(tmp, "land/year=2024/month=01/a.csv", "a\n1\n")
    run(spark, tmp)
    put(tmp, "land/year=1980/month=01/old.csv", "a\n2\n", mtime=315_600_000)
    assert run(spark, tmp).total_rows == 2


def jobs_of(spark, fn):
    """Jobs that Spark starts while ``fn`` runs."""
    count = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    before = count()
    fn()
    return count() - before


def test_headers_of_many_files_in_one_job(spark, tmp):
    texts = ["a,b\n1,2\n", "\n\n  x y,z\r\n1,2\r\n", 'c,"d, e",,\r1,2,3,4\r', '"a\\"b",c\n1,2\n', "only\n1\n", '"a""b",c\n', "\n\n", " a, \"b\" ,\n1,2,3\n"]
    want = [("a", "b"), ("  x y", "z"), ("c", "d, e", "", ""), ('a"b', "c"), ("only",), ('"a""b"', "c"), (), (" a", ' "b" ', "")]
    paths = [put(tmp, f"h/f {i}%25[{k}].csv", t) for k in range(5) for i, t in enumerate(texts)]
    for lengths in (None, dict.fromkeys(paths, 1)):
        got = read_headers(spark, paths, IngestOptions(), lengths)
        assert [got[p] for p in paths] == want * 5
    full = [p for p, w in zip(paths, want * 5) if w]
    few, many = (jobs_of(spark, lambda n=n: read_headers(spark, full[:n], IngestOptions())) for n in (3, 30))
    assert few == many == 1
    few, many = (jobs_of(spark, lambda n=n: read_headers(spark, full[:n], IngestOptions(), dict.fromkeys(full, 1))) for n in (3, 30))
    assert few == many <= 2


def test_header_of_a_long_file_does_not_read_it(spark, tmp):
    path = put(tmp, "h/long.csv", "a,b\n" + "1,2\n" * 2_000_000)
    started = time.time()
    assert read_headers(spark, [path], IngestOptions(multi_line=True))[path] == ("a", "b")
    assert time.time() - started < 20
    quoted = put(tmp, "h/q.csv", '"a\nb",c\n1,2\n')
    assert read_headers(spark, [quoted], IngestOptions(multi_line=True))[quoted] == ("a\nb", "c")
    assert read_headers(spark, [quoted], IngestOptions())[quoted] == ("a",)


def test_files_that_share_a_task_keep_their_headers(spark, tmp, monkeypatch):
    """Settings that put several files into a task cost a second reading, not a header."""
    from quayside.streaming import ingest

    monkeypatch.setattr(ingest, "WHOLE_FILES", {})
    paths = [put(tmp, f"h/{i}.csv", f"a{i},b\n1,2\n") for i in range(40)]
    assert read_headers(spark, paths, IngestOptions()) == {p: (f"a{i}", "b") for i, p in enumerate(paths)}


def test_jobs_of_a_load_do_not_grow_with_its_files(spark, tmp):
    counts = []
    run(spark, f"{tmp}/none")
    for n in (4, 24):
        for i in range(n):
            put(f"{tmp}/{n}", f"land/year=2024/month=01/f{i}.csv", f"A,B\n{i},2\n")
        counts.append(jobs_of(spark, lambda n=n: run(spark, f"{tmp}/{n}")))
    assert counts[0] == counts[1]


def test_batches_bounded_by_bytes(spark, tmp):
    for i in range(6):
        put(tmp, f"land/year=2024/month=01/s{i}.csv", "A\n" + "1\n" * 10)  # 22 bytes
    for i in range(2):
        put(tmp, f"land/year=2024/month=02/b{i}.csv", "A\n" + "1\n" * 100)  # 202 bytes
    r = run(spark, tmp, max_bytes_per_trigger=100)
    assert (r.status, r.total_rows) == ("success", 260)
    per_batch = table(spark, tmp).groupBy("_batch_id").agg({"_source_file": "collect_set"}).collect()
    sizes = [sum(22 if "/s" in f.rsplit("month=", 1)[1] else 202 for f in b[1]) for b in per_batch]
    assert all(s <= 100 or len(b[1]) == 1 for s, b in zip(sizes, per_batch)) and len({len(b[1]) for b in per_batch}) > 1


def test_misfits_are_rescued_by_column(spark, tmp):
    put(tmp, "land/year=2024/month=01/a.csv", "id,qty,at,note\n1,5,2024-01-01,x\n")
    run(spark, tmp)
    put(tmp, "land/year=2024/month=02/b.csv", 'id,qty,at,note\n2,"lots, and ""more",2024-01-02,y\n3,7,never,\n4,8\n5,,2024-01-05,z\n')
    r = run(spark, tmp)
    assert (r.status, r.rows_added) == ("success", 4)
    t = table(spark, tmp)
    rows = {x.id: (x.qty, x.r) for x in t.selectExpr("id", "qty", "to_json(_rescued) r").collect()}
    assert rows[1] == (5, None) and rows[3] == (7, '{"at":"never"}') and rows[4] == (8, None) and rows[5] == (None, None)
    assert rows[2][0] is None and rows[2][1].startswith('{"qty":')
    assert [x[0] for x in t.selectExpr("variant_get(_rescued, '$.at', 'string')").where("id = 3").collect()] == ["never"]


def test_statistics_from_the_batch_log(spark, tmp):
    from quayside.streaming.batch_log import SKETCH_ERROR, load_statistics

    for i in range(300):
        put(tmp, f"land/year=2024/month=01/f{i}.csv", "K,V\n" + "".join(f"{i * 7 + k},{k}\n" for k in range(14)))
    r = run(spark, tmp, max_files_per_trigger=60, sketch_columns=("k", "v", "absent"))
    assert (r.status, r.batches) == ("success", 5)
    stats = load_statistics(spark, f"{tmp}/ckpt/batches")
    rows = {x.column_name: x for x in stats.collect()}
    for column, exact in (("_source_file", 300), ("k", 7 * 301), ("v", 14)):
        assert abs(rows[column].distinct_estimate - exact) <= SKETCH_ERROR * exact
    assert set(rows) == {"_source_file", "k", "v"} and (rows["k"].rows, rows["k"].files, rows["k"].batches) == (4200, 300, 5)
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    assert "/table" not in plan and f"{tmp}/table" not in stats._jdf.queryExecution().executedPlan().toString()


def test_messy_files_grow_with_rows_not_one_a_thousand_keys(spark, tmp):
    from quayside.plans.derive import land_messy_orders

    orders = spark.range(20_000).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "'O' AS o_orderstatus", "id / 4 AS o_totalprice",
                                            "TIMESTAMP_NTZ '2000-01-02 03:04:05' AS o_orderdate", "'1-URGENT' AS o_orderpriority")
    land_messy_orders(orders, f"{tmp}/land")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{tmp}/land").select("path")
    assert files.count() == 5  # four kinds and the blank one; 81 before
    r = ingest_table(spark, f"{tmp}/land", f"{tmp}/t", f"{tmp}/ck", "t", IngestOptions(multi_line=True)).collect()[0]
    assert (r.status, r.rows_added, r.corrupt_rows, r.empty_files, r.batches) == ("success", 20_000, 0, 1, 1)


def test_listing_jobs_have_as_many_tasks_as_run_at_once(spark, tmp):
    from quayside.streaming.fsutil import LISTING_TASKS, bound_listing

    before = spark.conf.get(LISTING_TASKS)
    try:
        spark.conf.set(LISTING_TASKS, 10_000)
        bound_listing(spark)
        assert int(spark.conf.get(LISTING_TASKS)) == 2 * spark.sparkContext.defaultParallelism
        spark.conf.set(LISTING_TASKS, 3)  # a smaller setting stays
        bound_listing(spark)
        assert spark.conf.get(LISTING_TASKS) == "3"
    finally:
        spark.conf.set(LISTING_TASKS, before)


def tasks_of(spark, fn):
    """Tasks of the largest stage that Spark runs while ``fn`` runs."""
    group = f"tasks-{time.time()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        fn()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    return max((s.numTasks for j in jobs if j for s in map(tracker.getStageInfo, j.stageIds) if s), default=0)


def test_types_of_multi_line_files_are_inferred_by_several_tasks(spark, tmp):
    """A task of Spark's own inference takes multi-line files up to 128 MB together."""
    from quayside.streaming.ingest import _infer_types

    names = ["i", "b", "d", "day", "at", "text", "none", "flag", "lead", "odd", "kept"]
    line = '{k},{k}000000000,1.5,2024-01-0{k},2024-01-01 00:00:0{k},"a\nb, ""c"" \\",,true, {k},"{k}\n",00{k}\n'
    paths = [put(tmp, f"h/{k}.csv", ",".join(names) + "\n" + line.format(k=k) * 3) for k in range(1, 10)]
    opts = IngestOptions(multi_line=True, type_overrides={"kept": "string"})
    got = []
    wide = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # a file a task
        most = tasks_of(spark, lambda: got.extend(_infer_types(spark, paths, names, opts)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", wide)
    plain = spark.read.option("header", True).option("inferSchema", True).option("multiLine", True).csv(paths)
    assert got == [f.dataType.simpleString() for f in plain.schema.fields][:-1] + ["string"] and got[:6] == ["int", "bigint", "double", "date", "timestamp", "string"]
    assert most > 1


def test_plain_first_lines_are_not_parsed(spark, tmp, monkeypatch):
    """Small files with a plain first line cost one scan of their heads; others are read as before."""
    from quayside.streaming import ingest

    texts = ["a,b\n1,2\n", " a,b\n1,2\n", '"a\nb",c\n1,2\n', "a,b\r1,2\r", "\u00e4,b\n1,2\n", "a" * 5000 + ",b\n", "a,b", "only\n1\n", "a,,\r\n1,2,3\r\n"]
    want = [("a", "b"), (" a", "b"), ("a\nb", "c"), ("a", "b"), ("\u00e4", "b"), ("a" * 5000, "b"), ("a", "b"), ("only",), ("a", "", "")]
    paths = [put(tmp, f"h/{i}%25[x].csv{'@00001' if i else ''}", t) for i, t in enumerate(texts)]
    opts, lengths = IngestOptions(multi_line=True), dict.fromkeys(paths, 1)
    got = read_headers(spark, paths, opts, lengths)
    assert [got[p] for p in paths] == want
    plain = [paths[k] for k in (0, 3, 7, 8)]
    assert jobs_of(spark, lambda: read_headers(spark, plain, opts, lengths)) == 1  # a scan; two with the shuffle of parsed rows
    monkeypatch.setattr(ingest, "_PLAIN_ENCODINGS", set())
    assert read_headers(spark, paths, opts, lengths) == got


def test_quotable_text_is_that_of_translate(spark):
    from pyspark.sql import functions as F

    from quayside.plans.derive import quotable

    rows = spark.createDataFrame([('a"b\\c\r\nd""',), (None,), ("",), ("\u00e4\U0001f600\r",)], "t string")
    got = rows.select(quotable(F.col("t")).alias("a"), F.translate(F.coalesce("t", F.lit("")), '"\\\r', "'/").alias("b"))
    assert all(r.a == r.b for r in got.collect())


def test_batch_entry_is_replaced_by_a_replay(spark, tmp):
    from quayside.streaming import batch_log

    for rows in (5, 7):
        jobs = jobs_of(spark, lambda rows=rows: batch_log.write_entry(spark, f"{tmp}/log", 3, rows, None, 1, sketches={"c": b"x"}))
    assert jobs == 1
    batch_log.write_entry(spark, f"{tmp}/log", 4, 1, None, 0)
    got = batch_log.read_log(spark, f"{tmp}/log").orderBy("batch_id").collect()
    assert [(r.rows, r.batch_id, r.sketches) for r in got] == [(7, 3, {"c": bytearray(b"x")}), (1, 4, {})]
    assert batch_log.totals(spark, f"{tmp}/log", 3).added == 1
