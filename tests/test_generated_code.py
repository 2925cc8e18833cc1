"""The JVM doesn't compile a method of more than 8,000 bytes: a stage whose code is one such method runs many times slower."""

import re

import pytest

from innkeeper import catalog
from innkeeper.functions import columns as C
from tests.conftest import SF_SMALL

LIMIT = 8000


@pytest.fixture
def plain_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the code is there before a run
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("table", ["listings", "reviews", "calendar"])
def test_cleaning_is_made_of_methods_that_the_jvm_compiles(spark, plain_plans, capsys, table):
    getattr(catalog._b(spark, SF_SMALL).cleaned, table).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < LIMIT


def test_rarer_forms_of_numbers_beside_plain_ones(spark):
    texts = ["12", " 12.50 ", "-.5", "5.", "1e3", "1E-2", "0e309", "1e309", "inf", "-Infinity", "nan", "x", "", None, "9" * 400]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    got = [r.x for r in df.select("i", C.parse_number("t").alias("x")).collect()]
    inf = float("inf")
    assert got == [12.0, 12.5, -0.5, 5.0, 1000.0, 0.01, None, None, inf, -inf, None, None, None, None, inf]


def test_rarer_forms_of_ids_beside_plain_ones(spark):
    texts = ["12", " 7 ", "9007199254740993.0", "1.5e1", "120e-1", "-3.00", "0.0e5", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    assert [r.x for r in df.select("i", C.strict_bigint("t").alias("x")).collect()] == [12, 7, 9007199254740993, 15, 12, -3, 0, None]
    for wrong in ("12.5", "abc", "1e30", "125e-1", "", "9223372036854775808", "0e9999999999"):
        with pytest.raises(Exception, match="not an integer in id"):
            spark.createDataFrame([(wrong,)], "t string").select(C.strict_bigint("t")).collect()
