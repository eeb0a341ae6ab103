from datetime import date

import pytest

from factloom.operators.answers import checked_rows, first_list, model_facts
from pyspark.sql import functions as F


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ('```json\n[{"a": [1, 2]}]\n``` and [3]', [{"a": [1, 2]}]), ("so: [{'a': None}]", [{"a": None}]), ("[1, 2", []), ("none", []), ("", []), ("[x]", []), ("[]", []), ('["]"]', []), ("[" * 5000 + "]" * 5000, None),
    ],
)
def test_first_list(text, want):
    got = first_list(text)
    assert got == want if want is not None else isinstance(got, list)


def _checked(spark, rows, names=()):
    a = spark.createDataFrame([("d", "t", around, answer) for around, answer in rows], "infocode string, table_id string, table_text string, answer string").withColumn("r", F.lit(1)).withColumn("key", F.lit("k"))
    return checked_rows(a, spark.createDataFrame([("d", x) for x in names], "infocode string, name string"))


AROUND = "截至2024年6月30日止六個月 千港元"


def test_reasons(spark):
    answer = '[5, {"product_name": "酒店", "amount": "n/a"}, {"product_name": " ", "amount": "5"}, {"product_name": "毛利", "amount": "5"}, {"product_name": "毛利產品", "amount": 7, "period": "2023年6月"}, {"product_name": "總計", "amount": "(1,000)", "currency": "美元"}]'
    got = {r.fact_no: r for r in _checked(spark, [(AROUND, answer)], ["毛利產品甲"]).collect()}
    assert [got[k].reason for k in range(6)] == ["not_object", "amount_invalid", "empty_product_name", None, None, None]
    assert (got[4].start_date, got[4].end_date, got[4].amount, got[4].currency, got[4].unit) == (date(2022, 12, 31), date(2023, 6, 30), 7.0, "港元", "千港元")
    assert (got[5].product_name, got[5].amount, got[5].end_date, got[5].currency) == ("合计", -1000.0, date(2024, 6, 30), "美元")


def test_labels_without_a_product(spark):
    got = _checked(spark, [(AROUND, '[{"product_name": "毛利", "amount": "5"}, {"product_name": "收入", "amount": "5"}]'), (None, '[{"product_name": "酒店", "amount": "5"}]'), (AROUND, None)]).collect()
    assert sorted(r.reason for r in got) == ["metric_or_revenue_label", "metric_or_revenue_label", "no_report_date"]


def test_first_of_equal_facts(spark):
    answer = '[{"product_name": "酒 店A", "amount": "5"}, {"product_name": "酒店a", "amount": "6"}]'
    assert [(r.product_name, r.amount) for r in model_facts(_checked(spark, [(AROUND, answer)])).collect()] == [("酒 店A", 5.0)]
    assert model_facts(_checked(spark, [])).count() == 0
