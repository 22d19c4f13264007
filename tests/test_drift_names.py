"""Documents without unknown fields cost no variant."""

import pytest
from pyspark.sql import functions as F

from records import PLAIN, envelope, numbered, record
from tidelog.operators import classify as C
from tidelog.operators.parse import parse_changes
from tidelog.spec import SPECS


def _all_extra(specs):
    """Unknown fields the plain way: every document becomes a variant."""
    known = F.when(F.col("collection") == "orders", F.array(*map(F.lit, SPECS[0].known))).when(F.col("collection") == "products", F.array(*map(F.lit, SPECS[1].known)))
    known = known.otherwise(F.array().cast("array<string>"))
    return F.map_filter(F.col("document").try_cast("map<string, variant>"), lambda name, _: ~F.array_contains(known, name))


@pytest.fixture(scope="module")
def odd_documents(spark):
    documents = [
        PLAIN, {}, {**PLAIN, "loyalty": 7}, {**PLAIN, "nested": {"a": [1, {"b": None}]}}, {**PLAIN, "gone": None}, {**PLAIN, "": "empty name"},
        {**PLAIN, "status": {"deep": 1}}, {**PLAIN, "Status": "case"}, {"total": {"$numberDecimal": "1.5"}, "_id": "x", "$oid": 1}, None,
    ]
    rows = [record(envelope("c", d), topic=topic) for d in documents for topic in ("poc.mydb.orders", "poc.mydb.products", "poc.mydb.other")]
    texts = ('{"_id":"a","total":NaN}', '{"_id":"a","_id":"b","x":1,"x":2}', "{'_id':'a'}", '{"_id":"a"} {"x":1}', '{"a\\"b":1}', "[1]", "nonsense")
    rows += [record(envelope("c", text, stringified=False)) for text in texts]
    return parse_changes(numbered(spark, rows))


def test_unknown_fields_are_those_of_the_whole_variant(odd_documents):
    texts = odd_documents.select("offset", F.to_json(F.to_variant_object(C.extra_fields())).alias("got"), F.to_json(F.to_variant_object(_all_extra(SPECS))).alias("want"))
    # No unknown field, or nothing to read them from: both mean no drift.
    rows = [(r["got"] or "{}", r["want"] or "{}") for r in texts.collect()]
    assert [got for got, _ in rows] == [want for _, want in rows]
    assert sum(got != "{}" for got, _ in rows) > 8


def test_known_documents_do_not_become_variants(odd_documents):
    """The test on the names comes first; the variant is in the other branch."""
    plan = odd_documents.select(C.extra_fields().alias("extra"))._jdf.queryExecution().optimizedPlan().toString()
    assert "jsonObjectKeys" in plan or "json_object_keys" in plan
    (at,) = [line for line in plan.splitlines() if "parseJson" in line or "parse_json" in line]
    assert at.lower().index("keys") < at.lower().index("parse")
