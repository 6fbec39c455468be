import pytest

from tessera.spec import CatalogSpec, SpecError

STAR = {"metadata": {
    "key": {"DimProduct": ["code"], "DimCustomer": ["code"], "FactSales": ["sale"]},
    "association": {
        "DimProduct": {"PK": {"name": "product_pk", "int type": True, "relative value": True, "delete orphan": True}},
        "DimCustomer": {"PK": {"name": "customer_pk", "int type": True, "relative value": True}},
        "FactSales": {"FK": {"DimProduct": "product_fk",
                             "DimCustomer": {"name": "customer_fk", "delete orphan": False}}},
    },
    "in columns": {"FactSales": ["Qty", "Amount"]},
    "sort by": {"FactSales": {"by": ["sale", "Qty"], "ascending": [True, False]}},
}}


def test_star_spec_graph():
    spec = CatalogSpec.from_config(STAR)
    order = spec.topological_order()
    assert order.index("DimProduct") < order.index("FactSales")
    assert order.index("DimCustomer") < order.index("FactSales")
    assert spec.tables["DimProduct"].pk.relative
    fks = {fk.parent: fk for fk in spec.tables["FactSales"].fks}
    assert fks["DimProduct"].name == "product_fk" and not fks["DimProduct"].delete_orphan
    assert [c for c, _ in spec.children_of("DimProduct")] == ["FactSales"]
    assert spec.tables["FactSales"].required_columns == {"sale", "Qty", "Amount"}
    assert spec.tables["FactSales"].sort_by == [("sale", True), ("Qty", False)]


def test_unknown_key_rejected():
    with pytest.raises(SpecError):
        CatalogSpec.from_config({"nmae": "typo"})
    with pytest.raises(SpecError):
        CatalogSpec.from_config({"metadata": {"keys": {}}})


def test_cycle_rejected():
    cfg = {"metadata": {"key": {"a": ["x"], "b": ["y"]}, "association": {
        "a": {"PK": {"name": "pa"}, "FK": {"b": "fb"}}, "b": {"PK": {"name": "pb"}, "FK": {"a": "fa"}}}}}
    with pytest.raises(SpecError):
        CatalogSpec.from_config(cfg)


def test_csv_separator_both_places():
    assert CatalogSpec.from_config({"files": {"csv separator": ","}}).csv_separator == ","
    cfg = {"files": {"metadata file formatting": {"csv separator": "|"}}}
    assert CatalogSpec.from_config(cfg).csv_separator == "|"


def test_added_columns_not_required():
    cfg = {"metadata": {"key": {"_": ["correlationKey", "jsonFileName"]}, "in columns": {"_": ["clientName"]},
                        "add filename": {"_": "jsonFileName"},
                        "filename data format": {"_": r"(\w+)_(\d{8})_(?P<correlationKey>\w+-\w+)\.json$"}}}
    spec = CatalogSpec.from_config(cfg)
    assert spec.tables["_"].required_columns == {"clientName"}
