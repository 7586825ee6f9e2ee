"""Payload document: keys equal the parts; cross-part sums agree."""

import json

from starling.operators import payload
from starling.sources import tables as tb

from conftest import SF001


def test_document_and_invariants(spark):
    parts = payload.payload_parts(tb.star(spark, SF001))
    doc = json.loads(payload.payload_document(parts, generated_at="fixed").first().json)
    assert doc["status"] == "success"
    assert set(doc) == {"status", "generated_at", "metrics", "category_sales", "monthly_sales",
                        "monthly_signups", "rfm_segments", "recent_transactions"}
    rev = doc["metrics"]["total_revenue"]
    assert abs(sum(doc["category_sales"].values()) - rev) < 0.01
    assert abs(sum(doc["monthly_sales"].values()) - rev) < 0.01
    assert abs(sum(s["revenue"] for s in doc["rfm_segments"].values()) - rev) < 0.01
    assert sum(doc["monthly_signups"].values()) == doc["metrics"]["total_customers"]
    assert list(doc["rfm_segments"]) == ["Champions", "Loyal Customers", "New / Promising", "At Risk", "Lost"]
    assert len(doc["recent_transactions"]) == 10
    dates = [t["order_date"] for t in doc["recent_transactions"]]
    assert dates == sorted(dates, reverse=True)


def test_write_payload(spark, tmp_dir):
    parts = payload.payload_parts(tb.star(spark, SF001))
    payload.write_payload(payload.payload_document(parts), f"{tmp_dir}/data")
    text = spark.read.text(f"{tmp_dir}/data").collect()
    assert len(text) == 1 and json.loads(text[0].value)["status"] == "success"
