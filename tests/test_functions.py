from pyspark.sql import functions as F

from quayside.functions import (
    MONTH_NAMES,
    expand_template,
    int_or_null,
    month_name,
    partition_path,
    period_grid,
    previous_period,
    quarter_label,
    snake_case,
    snake_case_col,
    unique_snake_names,
)


def test_snake_case_rule():
    assert snake_case("Parcel ID") == "parcel_id"
    assert snake_case("Cost ($)") == "cost"
    assert snake_case("OrganizationName") == "organizationname"
    assert snake_case("Some__Column") == "some_column"
    assert snake_case("Total-Cost") == "total_cost"
    assert snake_case("Date of Service") == "date_of_service"
    assert snake_case("_x") == "x"
    assert snake_case("Año") == "a_o"
    assert snake_case("###") == ""


def test_unique_names_fix_collisions_and_empty():
    names = unique_snake_names(["A B", "A-B", "###", "a_b", "_load_timestamp"], reserved=("_load_timestamp",))
    assert names == ["a_b", "a_b_2", "col_3", "a_b_3", "load_timestamp"]


def test_snake_case_expression_matches_python(spark):
    vals = ["Parcel ID", "Cost ($)", "__a-B c__", "Año", "###", "x1_y2"]
    df = spark.createDataFrame([(v,) for v in vals], ["v"])
    got = [r.s for r in df.select(snake_case_col("v").alias("s")).collect()]
    assert got == [snake_case(v) for v in vals]


def test_month_name_and_quarter_range(spark):
    df = spark.range(0, 15).select(F.col("id").cast("int").alias("m"))
    rows = {r.m: (r.n, r.q) for r in df.select("m", month_name("m").alias("n"), quarter_label("m").alias("q")).collect()}
    assert rows[0] == (None, None) and rows[13] == (None, None)
    assert [rows[m][0] for m in range(1, 13)] == MONTH_NAMES
    assert [rows[m][1] for m in (1, 3, 4, 6, 7, 9, 10, 12)] == ["q1", "q1", "q2", "q2", "q3", "q3", "q4", "q4"]


def test_period_grid(spark):
    g = period_grid(spark, 2020, 2024)
    assert g.count() == 60
    first = g.orderBy("period_start").first()
    assert (first.year, first.month, first.month_name, first.quarter) == (2020, 1, "january", "q1")


def test_previous_period(spark):
    df = spark.createDataFrame([("2024-01-15",), ("2024-03-01",)], ["d"]).select(F.col("d").cast("date").alias("d"))
    got = [str(r.p) for r in df.select(previous_period("d").alias("p")).collect()]
    assert got == ["2023-12-01", "2024-02-01"]


def test_expand_template_keeps_unknown(spark):
    df = spark.range(1).select(expand_template(F.lit("https://e/{year}/{month_name}/{x}"),
                                               {"year": F.lit(2024), "month_name": F.lit("january")}).alias("u"))
    assert df.first().u == "https://e/2024/january/{x}"


def test_partition_path_branches(spark):
    rows = [(2024, 3), (2024, None), (None, 3), (0, 5), (2024, 0)]
    df = spark.createDataFrame(rows, "y int, m int")
    got = [r.p for r in df.select(partition_path(F.lit("b"), "y", "m").alias("p")).collect()]
    assert got == ["b/year=2024/month=03", "b/year=2024", "b", "b", "b/year=2024"]


def test_int_or_null(spark):
    df = spark.createDataFrame([("",), ("12",), ("x",), (None,)], ["s"])
    assert [r.i for r in df.select(int_or_null("s").alias("i")).collect()] == [None, 12, None, None]


def test_snake_case_expression_equals_rule_on_random_text(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    texts: list[str] = []

    @settings(max_examples=300, deadline=None)
    @given(st.text(min_size=0, max_size=40))
    def collect(t):
        texts.append(t)

    collect()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.s for r in df.select("i", snake_case_col("t").alias("s")).collect()}
    assert all(got[i] == snake_case(t) for i, t in enumerate(texts))


def test_unique_names_are_unique_and_nonempty():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.text(max_size=12), max_size=15))
    def check(names):
        out = unique_snake_names(names, reserved=("_batch_id",))
        assert len(out) == len(names) and len(set(out)) == len(out)
        assert all(o and o != "_batch_id" for o in out)

    check()
