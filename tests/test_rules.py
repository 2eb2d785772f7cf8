"""Rules over records."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from docframe.operators.rules import Holds, InOrder, SumsTo, UniqueOver, rule_violations

SHAPE = "doc_id long, number string, total decimal(18,2), since date, due date, city string"
RECORDS = [
    (1, "A", Decimal("10.00"), date(2020, 1, 2), date(2020, 1, 1), "Roma"),
    (2, "A", Decimal("5.00"), date(2020, 1, 1), date(2020, 1, 1), None),
    (3, "B", None, None, date(2020, 1, 1), "Bari"),
    (4, "C", Decimal("0.00"), date(2020, 1, 1), None, "Bari"),
    (5, None, Decimal("3.00"), None, None, ""),
]
ITEMS = [(1, "amount", "4,00 EUR"), (1, "amount", "6.00"), (1, "tax", "9"), (2, "amount", "5.02"), (5, "amount", "n/a"), (5, "amount", None), (9, "amount", "1")]
RULES = [SumsTo("total", "amount", Decimal("0.01")), InOrder(("since", "due")), UniqueOver(("number",)), UniqueOver(("number", "city")), Holds("city", lambda c: c("city") != "", "a city")]


def broken(spark, rules, records=RECORDS, items=ITEMS):
    found = rule_violations(spark.createDataFrame(records, SHAPE), rules, spark.createDataFrame(items, "doc_id long, name string, value string"))
    return sorted(tuple(r) for r in found.collect())


def test_each_kind_of_rule(spark):
    assert broken(spark, RULES) == sorted([
        (1, "order", "since to due", "at least 2020-01-02", "2020-01-01"),
        (1, "unique", "number", "in one document, first in 1", "A in 2"), (2, "unique", "number", "in one document, first in 1", "A in 2"),
        (2, "sum", "amount to total", "5.00", "5.02"), (5, "sum", "amount to total", "3.00", "1 values are no amounts"), (5, "holds", "city", "a city", ""),
    ])


def test_none_and_nothing(spark):
    assert broken(spark, []) == [] and broken(spark, RULES, []) == []
    assert broken(spark, [UniqueOver(("city",))]) == [(d, "unique", "city", "in one document, first in 3", "Bari in 2") for d in (3, 4)]


def test_a_value_of_very_many_documents(spark):
    records = [(k, "same" if k % 3 else f"n{k}", None, None, None, None) for k in range(3000)]
    assert len(broken(spark, [UniqueOver(("number",))], records)) == 2000
