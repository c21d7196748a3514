from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerfold import schemas
from ledgerfold.operators.nested import lookup
from ledgerfold.plans import carriers as delivery
from ledgerfold.plans.cleanup import normalise_shipments
from ledgerfold.session import land
from ledgerfold.sources.files import unwrap_id


@pytest.fixture(scope="module")
def documents(spark):
    """Two documents of one carrier, an empty and a missing array, a null element."""
    rows = [
        (
            ("a1",),
            "DHL",
            [
                (1, "2023-01-01T23:00:00Z", "2023-01-02T01:00:00Z", "t1"),
                (2, "2023-01-01", "2023-01-05", "t2"),
            ],
        ),
        (("a2",), "DHL", [(3, "2023-01-03", None, "t3"), (4, "2023-01-04", "2023-01-03", None)]),
        (("b1",), "UPS", []),
        (("c1",), "CTT", None),
        (("d1",), "GLS", [None, (5, "2023-01-01", "2023-01-11", "t5")]),
    ]
    return spark.createDataFrame(rows, schemas.LOGISTIC_TRANSPORT)


@pytest.fixture(scope="module")
def carriers(documents):
    return land(normalise_shipments(documents), "carriers")


def test_dates_inside_the_array(carriers):
    first = carriers.where("name = 'DHL'").orderBy("_id").head()["transport"][0]
    assert first["shippingDate"] == datetime(2023, 1, 1, 23)
    assert first["trackingNumber"] == "t1"
    arrays = {r["name"]: r["transport"] for r in carriers.collect()}
    assert arrays["UPS"] == [] and arrays["CTT"] is None and arrays["GLS"][0] is None


def test_repair_twice_changes_nothing(carriers):
    again = normalise_shipments(carriers)
    assert again.schema == carriers.schema
    assert sorted(map(str, again.collect())) == sorted(map(str, carriers.collect()))


def test_null_elements_as_documents(documents):
    arrays = {r["name"]: r["transport"] for r in normalise_shipments(documents, null_element="document").collect()}
    assert tuple(arrays["GLS"][0]) == (None, None, None, None)


def test_average_counts_midnights_and_skips_missing_dates(carriers):
    got = dict(tuple(r) for r in delivery.average_delivery_days(carriers).collect())
    assert got == {"DHL": (1 + 4 - 1) / 3, "GLS": 10.0}


def test_average_with_shipments(carriers):
    documents = delivery.delivery_days_with_shipments(carriers).collect()
    got = Counter(
        (d["name"], s["saleID"], s["differenceBetweenDays"]) for d in documents for s in d["transport"]
    )
    assert got == Counter(
        [("DHL", 1, 1), ("DHL", 2, 4), ("DHL", 3, None), ("DHL", 4, -1), ("GLS", None, None), ("GLS", 5, 10)]
    )
    assert {(d["name"], d["avgDifferenceBetweenDays"]) for d in documents} == {
        ("DHL", 4 / 3),
        ("GLS", 10.0),
    }
    assert len(documents) == 2


def test_a_carrier_of_many_shipments_is_one_row(spark):
    """As the data of three carriers is: every one has more shipments than fit a page."""
    many = spark.range(25_000).selectExpr(
        "id AS saleid", "'2023-01-01' AS shippingDate", "'2023-01-03' AS deliveryDate", "'t' AS trackingNumber"
    )
    names = spark.createDataFrame([("DHL",)], "name STRING")
    carriers = lookup(names.withColumn("k", F.lit(1)), many.withColumn("k", F.lit(1)), "k", "k", "transport", many.columns)
    dated = normalise_shipments(carriers.withColumn("_id", F.lit("x")))
    assert [tuple(r) for r in delivery.shipment_counts(dated).collect()] == [("x", "DHL", 25_000)]
    (row,) = delivery.delivery_days_with_shipments(dated).collect()
    assert (len(row["transport"]), row["avgDifferenceBetweenDays"]) == (25_000, 2.0)


def test_shipment_counts(carriers):
    got = {r["_id"][0]: (r["name"], r["NTransportes"]) for r in delivery.shipment_counts(carriers).collect()}
    assert got == {"a1": ("DHL", 2), "a2": ("DHL", 2), "b1": ("UPS", 0), "c1": ("CTT", None), "d1": ("GLS", 2)}
    with pytest.raises(Exception, match="not an array"):
        delivery.shipment_counts(carriers, strict=True).collect()


def test_carrier_list_keeps_the_id(carriers):
    got = {tuple(r) for r in unwrap_id(delivery.carrier_list(carriers)).collect()}
    assert ("a1", "DHL") in got and len(got) == 5


def test_flat_list_has_dates_as_text(carriers):
    rows = [tuple(r) for r in delivery.shipment_list(carriers).orderBy(F.col("saleid")).collect()]
    assert rows == [
        (None, "GLS", None, None, None),
        (1, "DHL", "2023-01-01", "2023-01-02", "t1"),
        (2, "DHL", "2023-01-01", "2023-01-05", "t2"),
        (3, "DHL", "2023-01-03", None, "t3"),
        (4, "DHL", "2023-01-04", "2023-01-03", None),
        (5, "GLS", "2023-01-01", "2023-01-11", "t5"),
    ]


def test_average_reads_two_leaves_and_shuffles_partial_sums(carriers, plan):
    text = plan(delivery.average_delivery_days(carriers))
    assert "transport:array<struct<shippingDate:timestamp_ntz,deliveryDate:timestamp_ntz>>" in text
    assert text.count("Exchange") == 1 and "partial_avg" in text


def test_average_with_shipments_is_one_scan_and_one_shuffle(carriers, plan):
    text = plan(delivery.delivery_days_with_shipments(carriers))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "trackingNumber" not in text
