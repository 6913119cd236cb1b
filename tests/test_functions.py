import pytest
from pyspark.sql import functions as F

from quillon.functions import numbers, text
from quillon.plans import regional


def _one(spark, f, value):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("f, value, want", [
    (numbers.numeric_safe, "1,234", None), (numbers.numeric_safe, "1.234,50", 1234.5), (numbers.numeric_safe, "$ 12.5%", 12.5), (numbers.numeric_safe, "nan", None), (numbers.numeric_safe, None, None),
    (numbers.budget_numeric, "1,234", 1234.0), (numbers.budget_numeric, "-", None), (numbers.int_safe, "1,234", 1234), (numbers.int_safe, "45.6", 45),
    (text.repair_mojibake, "ACADÃ‰MICA", "ACADÉMICA"), (text.repair_mojibake, "precio €5", "precio €5"), (text.repair_mojibake, "Perú", "Perú"),
    (text.match_key, "  Ñandú (x) ", "NANDU X"), (text.match_key, " ", None), (text.is_total, "Total Perú", False), (text.is_total, None, False),
])
def test_vectors(spark, f, value, want):
    assert _one(spark, f, value) == want


def test_scores_of_nulls_and_equals(spark):
    rows = spark.createDataFrame([("a", 1, None, 1.0, 1.0, 1.0, 1.0), ("b", 1, None, 1.0, 1.0, 1.0, 1.0), ("c", 2, None, None, None, None, None)], "region string, year int, poverty double, demand double, youth double, digital double, rurality double")
    got = {r["region"]: (r["priority_score"], r["tier"], r["priority_rank"]) for r in regional.priority(rows).collect()}
    assert got == {"a": (0.0, "Baja", 1), "b": (0.0, "Baja", 1), "c": (None, "Insuficiente", 1)}
