"""Warehouse-size operators on literal rows."""

from perkspark.operators.warehouse import lines_sum_distinct


def test_lines_sum_distinct_keeps_a_null_flag_group_in_every_branch(spark):
    rows = [
        (None, 1.0, 1, 10, 5.0),
        (None, 2.0, 2, 10, 7.0),
        ("A", 3.0, 1, 11, 1.0),
        ("A", 5.0, 1, 12, 3.0),
        ("R", 1.0, 9, 9, 2.0),
    ]
    df = spark.createDataFrame(
        rows, "l_returnflag string, l_quantity double, l_orderkey long, l_suppkey long, l_extendedprice double"
    )
    got = {r.l_returnflag: tuple(r)[1:] for r in lines_sum_distinct(df).collect()}
    assert got == {
        None: (2, 1.5, 2, 1, 1.41),
        "A": (2, 4.0, 1, 2, 1.41),
        "R": (1, 1.0, 1, 1, None),
    }
