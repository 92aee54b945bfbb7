from pyspark.sql import functions as F

from folioflow.operators import rejects as R

SCHEMA = "record_no long, file_name string, line_no int, raw_text string, paper string, errors int"


def reasons(spark, rows):
    df = spark.createDataFrame([(i, f, n, t, "clash", 0) for i, (f, n, t) in enumerate(rows)], SCHEMA)
    parsed = R.abstract_records(df)
    bad = {r.record_no: r.reason for r in R.rejected(parsed).collect()}
    good = {r.record_no: (r.paper, r.abstract) for r in R.loaded(parsed).collect()}
    return bad, good


def test_reasons_and_values(spark):
    rows = [
        ("a.csv", 1, "paper,abstract"),
        ("a.csv", 2, 'w12,"one, ""two""\nthree"'),
        ("a.csv", 3, "12,"),
        ("a.csv", 4, 'w1,"open'),
        ("a.csv", 5, 'w1,"closed"x'),
        ("a.csv", 6, "w1,a,b"),
        ("a.csv", 7, "w1"),
        ("a.csv", 8, "q1,text"),
        ("a.csv", 9, "w1234567,text"),
        ("a.csv", 10, "w1,bad�"),
        ("a.csv", 11, "w1,bad\x07"),
        ("a.csv", 12, "w1,tab\tand \"quote\" are text"),
        ("b.tsv", 2, "t9\ta, b"),
        ("b.TSV", 3, 't9\t"a\tb"'),
        ("b.tsv", 4, "t9,text"),
        ("a.csv", 13, None),
        ("a.csv", 14, ""),
        ("a.csv", None, " w5 ,NULL"),
        ("a.csv", 15, "w１,x"),
    ]
    bad, good = reasons(spark, rows)
    assert bad == {3: "quoting", 4: "quoting", 5: "column_count", 6: "column_count", 7: "value", 8: "value", 9: "value", 10: "value", 14: "column_count", 15: "column_count", 16: "column_count", 18: "value"}
    assert good[1] == ("w12", 'one, "two"\nthree') and good[2] == ("12", "") and good[12] == ("t9", "a, b") and good[13] == ("t9", "a\tb") and good[17] == (" w5 ", "NULL")


def test_very_long_text_needs_no_stack(spark):
    body = '""x' * 200_000
    bad, good = reasons(spark, [("a.csv", 2, f'w1,"{body}"'), ("a.csv", 3, f'w1,"{body}')])
    assert bad == {1: "quoting"} and len(good[0][1]) == 400_000


def test_casts_and_empty_table(spark):
    df = spark.createDataFrame([("1,2024-02-30",), ("x,2024-02-28",), ("3,",)], "raw string")
    fields = [R.Field("n", "int"), R.Field("d", "date")]
    parsed = R.parse_delimited(df, "raw", fields, [])
    assert [r.errors for r in parsed.collect()] == [["value"], ["value"], []]
    assert R.loaded(parsed).select("n").first().n == 3
    assert R.rejected(R.parse_delimited(df.where(F.lit(False)), "raw", fields, [])).count() == 0
