"""The reference's star scenario (products, customers, sales): initial load,
dimension update with re-numbered incoming PKs, fact update + insert, and
orphan handling."""

from pyspark.sql import functions as F

from conftest import rows
from tessera.plans.load import load_related
from tessera.spec import CatalogSpec

SPEC = CatalogSpec.from_config({"metadata": {
    "key": {"DimProduct": ["code"], "DimCustomer": ["code"], "FactSales": ["sale"]},
    "association": {
        "DimProduct": {"PK": {"name": "product_pk", "int type": True, "relative value": True, "delete orphan": True}},
        "DimCustomer": {"PK": {"name": "customer_pk", "int type": True, "relative value": True,
                               "delete orphan": False}},
        "FactSales": {"FK": {"DimProduct": {"name": "product_fk", "delete orphan": True},
                             "DimCustomer": {"name": "customer_fk", "delete orphan": True}}},
    }}})


def _delta(spark, file_seq, products, customers, sales):
    def mk(data, schema):
        return spark.createDataFrame(data, schema).withColumn("_file_seq", F.lit(file_seq)) \
            .withColumn("_row_seq", F.monotonically_increasing_id())
    out = {}
    if products:
        out["DimProduct"] = mk(products, "product_pk string, code string, name string")
    if customers:
        out["DimCustomer"] = mk(customers, "customer_pk string, code string, name string")
    if sales:
        out["FactSales"] = mk(sales, "sale string, product_fk string, customer_fk string, Qty string, Amount string")
    return out


def _sales(cat):
    p = {r["product_pk"]: r["code"] for r in cat["DimProduct"].collect()}
    c = {r["customer_pk"]: r["code"] for r in cat["DimCustomer"].collect()}
    return sorted((r["sale"], p.get(r["product_fk"]), c.get(r["customer_fk"]), r["Qty"], r["Amount"])
                  for r in cat["FactSales"].collect())


def test_star_load_update_orphans(spark):
    # I: one file with everything
    cat = load_related({}, _delta(spark, 1, [("1", "P1", "W'dget"), ("2", "P2", "Gadget")],
                                  [("1", "C1", "Alice"), ("2", "C2", "Bob")],
                                  [("S1", "1", "1", "2", "20"), ("S2", "2", "2", "1", "10")]), SPEC)
    assert sorted(r["product_pk"] for r in cat["DimProduct"].collect()) == [1, 2]
    assert _sales(cat) == [("S1", "P1", "C1", "2", "20"), ("S2", "P2", "C2", "1", "10")]
    # J: the dimension re-posted under other relative PKs, P1's name fixed
    cat = load_related(cat, _delta(spark, 2, [("7", "P1", "Widget")], None, None), SPEC)
    assert rows(cat["DimProduct"], "code", "name", "product_pk") == [("P1", "Widget", 1), ("P2", "Gadget", 2)]
    # K: S1 updated, S3 new (its FKs are file-relative: product 5 = P2 in this file)
    cat = load_related(cat, _delta(spark, 3, [("5", "P2", None)], [("9", "C1", None)],
                                   [("S1", None, None, "3", "30"), ("S3", "5", "9", "4", "40")]), SPEC)
    assert _sales(cat) == [("S1", "P1", "C1", "3", "30"), ("S2", "P2", "C2", "1", "10"),
                           ("S3", "P2", "C1", "4", "40")]
    # L: all sales now point to P1/C1 -> P2 is an orphan (deleted), C2 is kept (no delete orphan)
    cat = load_related(cat, _delta(spark, 4, [("1", "P1", None)], [("1", "C1", None)],
                                   [("S2", "1", "1", None, None), ("S3", "1", "1", None, None)]), SPEC)
    assert rows(cat["DimProduct"], "code") == [("P1",)]
    assert rows(cat["DimCustomer"], "code") == [("C1",), ("C2",)]
