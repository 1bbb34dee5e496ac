import pytest
from pyspark.sql import functions as F

from tallyloom import functions as fn


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def array(*numbers):
    return F.array(*[F.lit(float(n)) for n in numbers])


@pytest.mark.parametrize(
    "part, whole, decimals, expected",
    [(9, 8, 2, 1.13), (1, 8, 2, 0.13), (201, 200, 2, 1.01), (1, 3, 4, 0.3333), (0, 7, 2, 0.0), (5, 1, 2, 5.0)],
)
def test_half_up_ratio(spark, part, whole, decimals, expected):
    assert value(spark, fn.half_up_ratio(F.lit(part), F.lit(whole), decimals)) == expected


def test_half_up_ratio_of_nothing_is_null(spark):
    assert value(spark, fn.half_up_ratio(F.lit(1), F.lit(0), 2)) is None


def test_hit_rate(spark):
    assert value(spark, fn.hit_rate(F.lit(0), F.lit(0))) == 0.0
    assert value(spark, fn.hit_rate(F.lit(1), F.lit(4))) == 0.25


def test_text_helpers(spark):
    assert value(spark, fn.first_char(F.lit("3-pt jump shot"))) == "3"
    assert value(spark, fn.fixed_text(F.lit(0.125), 2)) == "0.13"
    pieces = value(spark, fn.words(F.lit(" a\tB\n\nc\r\fd ")))
    assert [p for p in pieces if p] == ["a", "B", "c", "d"]


@pytest.mark.parametrize("number, expected", [(-7, -1), (0, 0), (3, 1)])
def test_sign(spark, number, expected):
    assert value(spark, fn.sign(F.lit(number))) == expected


def test_integer_quotient(spark):
    assert value(spark, fn.integer_quotient(F.lit(7).cast("long"), F.lit(2).cast("long"))) == 3
    assert value(spark, fn.integer_quotient(F.lit(7).cast("long"), F.lit(0).cast("long"))) is None


def test_array_helpers(spark):
    a, b = array(1, 2), array(3, 5)
    assert value(spark, fn.dot(a, b)) == 13.0
    assert value(spark, fn.squared_distance(a, b)) == 13.0
    assert value(spark, fn.outer_product(a, b)) == [3.0, 5.0, 6.0, 10.0]
    assert value(spark, fn.bilinear(a, [[1, 0], [0, 2]], b)) == 23.0
    assert value(spark, fn.logistic(F.lit(0.0))) == 0.5


def test_shuffle_tasks():
    from tallyloom.session import TASK_BYTES, shuffle_tasks

    assert shuffle_tasks(1) == 200
    assert shuffle_tasks(1000 * TASK_BYTES + 1) == 1001
