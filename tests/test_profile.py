"""Profile: expressions, medians, odd loads, checks."""

from pyspark.sql import functions as F

from corvane.operators.profile import HEX, Profile, TableSpec, exact_medians, find_issues, induce_expressions, is_uuid, real_date, real_time, regex_of


def test_expressions_conform(spark):
    values = [("d", f"2024-{m:02}-{d:02}") for m in range(1, 13) for d in range(1, 25)] + [("d", "soon"), ("d", "12/31/24?")]
    out = {r.value: r.expression for r in induce_expressions(spark.createDataFrame(values, "column_name string, value string")).collect()}
    assert out["2024-05-06"] is not None and out["soon"] is None and out["12/31/24?"] is None
    assert len({v for v in out.values() if v}) == 1


def test_uuid_column_gets_one_expression(spark):
    import uuid

    values = [("u", str(uuid.UUID(int=i * 7919 + 2**100))) for i in range(200)] + [("u", "X" * 5)]
    out = [r.expression for r in induce_expressions(spark.createDataFrame(values, "column_name string, value string")).collect()]
    assert out.count(None) == 1 and len({e for e in out if e}) == 1


def test_medians(spark):
    rows = [("c", 1, str(x), 1, 1, float(x)) for x in (1, 2, 3, 4)] + [("c", 2, "5", 3, 2, 5.0), ("c", 2, "9", 1, 0, 9.0)]
    out = {r.load_no: r.median for r in exact_medians(spark.createDataFrame(rows, "column_name string, load_no int, value string, n long, good long, num double")).collect()}
    assert out == {1: 2.5, 2: 5.0}


def _issues(spark, rows):
    df = spark.createDataFrame(rows, "id long, load_no int, n int, who string, name string")
    spec = TableSpec("t", "load_no", "id", ["n", "who"], {"n": ~F.col("n").between(0, 100)}, ["n"], ["who"])
    p = Profile(df, spec)
    return {(r.column_name, r.issue, r.case_key) for r in find_issues(p, nulls=["n"], shift=["n"], distinct=["who"]).collect()}


def test_odd_loads_and_cells(spark):
    rows = []
    for load in range(1, 13):
        for i in range(20):
            n = 10 + i % 3
            if load == 3:
                n = None if i < 10 else n
            if load == 5:
                n = 40
            rows.append((load * 100 + i, load, n, f"w{i % (2 if load == 7 else 8)}", None))
    rows.append((9999, 1, -5, None, "x"))
    rows.append((10000, None, 500, None, "x"))
    assert _issues(spark, rows) == {("n", "cell", 9999), ("n", "cell", 10000), ("n", "nulls", 3), ("n", "shift", 5), ("who", "distinct", 7)}


def test_empty_table(spark):
    assert _issues(spark, []) == set()


def test_checks(spark):
    df = spark.createDataFrame([("2024-02-29",), ("2023-02-29",), ("2024-2-9",), (None,)], "d string")
    assert [r[0] for r in df.select(real_date("d")).collect()] == [True, False, False, False]
    df = spark.createDataFrame([("2024-02-29T23:59:59Z",), ("2024-02-29T24:00:00Z",), ("2024-02-29 10:00:00",)], "t string")
    assert [r[0] for r in df.select(real_time("t")).collect()] == [True, False, False]
    df = spark.createDataFrame([("0b0e7a52-0000-4000-8000-00000000000a",), ("0B0e7a52-0000-4000-8000-00000000000a",)], "u string")
    assert [r[0] for r in df.select(is_uuid("u")).collect()] == [True, False]


def test_expressions_read_as_regular_expressions():
    assert regex_of("c:9999-99") == r"^[0-9]{4}\-[0-9]{2}$" and regex_of("r:A+a+ 9++") == r"^[A-Z]+[a-z]+\ [0-9]+\+$"
    assert regex_of(f"h:{HEX * 2}-h") == r"^[0-9a-f]{2}\-h$" and regex_of("w:www.w") == r"^[A-Za-z0-9]{3}\.[A-Za-z0-9]$"
