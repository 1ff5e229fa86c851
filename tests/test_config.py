"""The rule file's contract."""

import json

import pytest
from pyspark.sql import functions as F

from sift import ConfigError, GateConfig, load_config, plan_gate
from sift.sources import paths
from sift.sources.rulefile import LIST_KEYS, PATH_KEYS, UNUSED_KEY
from workload.dirty_orders import rule_document


@pytest.fixture
def stored(spark, tmp_path):
    def load(document, name="orders.json", **options):
        file = tmp_path / name
        file.write_text(document if isinstance(document, str) else json.dumps(document, indent=2))
        return load_config(spark, str(file), **options)

    return load


def test_loads_all_keys(stored):
    document = rule_document("/lake")
    config = stored(document)
    for key in PATH_KEYS:
        assert getattr(config, key) == document[key]
    for key in LIST_KEYS:
        assert list(getattr(config, key)) == document[key]
    assert config.cols_datatype == document["cols_datatype"][0]
    assert config.paths("1998/08/10") == paths.GatePaths(
        "/lake/landing/orders/1998/08/10",
        "/lake/target/orders/1998/08/10",
        "/lake/pending/orders/1998/08/10",
        "/lake/audit/orders/1998/08/10",
    )


def test_first_document_of_an_array_counts(stored):
    assert stored([rule_document("/one"), rule_document("/two")]).sourcefile.startswith("/one")


@pytest.mark.parametrize("key", [*PATH_KEYS, *LIST_KEYS, UNUSED_KEY])
def test_missing_key(stored, key):
    document = rule_document()
    del document[key]
    with pytest.raises(ConfigError, match=key):
        stored(document)


def test_all_problems_come_at_once(stored):
    document = rule_document()
    del document["auditfile"]
    document["null_check"] = "status"
    with pytest.raises(ConfigError, match="auditfile.*null_check"):
        stored(document)


def test_unknown_key(stored):
    document = rule_document() | {"cols_datatypes": []}
    with pytest.raises(ConfigError, match="cols_datatypes"):
        stored(document)
    assert stored(document, strict=False).required_cols


@pytest.mark.parametrize("casts", [[], [{}], {}, None, "absent"])
def test_no_casts(stored, casts):
    document = rule_document() | {"cols_datatype": casts}
    if casts == "absent":
        del document["cols_datatype"]
    assert stored(document).cols_datatype == {}


def test_of_two_cast_structs_the_first_counts(stored):
    document = rule_document() | {"cols_datatype": [{"order_id": "int"}, {"amount": "double"}]}
    assert stored(document).cols_datatype == {"order_id": "int"}


def test_empty_rule_lists(spark, stored):
    document = rule_document() | {
        "null_check": [],
        "dateformatchecks": [],
        "no_negative_value": [],
        "cols_datatype": [],
        "required_cols": ["a"],
    }
    source = spark.createDataFrame([("1", None), ("1", None), (None, "-5")], "a string, b string")
    gate = plan_gate(source, stored(document))
    assert sorted(gate.accepted().collect(), key=str) == [("1",), (None,)]
    assert gate.rejects().collect() == [("1", None, "Duplicate record")]


def test_invalid_json(stored):
    with pytest.raises(ConfigError, match="JSON"):
        stored("{ not json")


def config(**changes):
    return GateConfig.from_mapping(rule_document() | {"cols_datatype": []} | changes)


@pytest.mark.parametrize(
    "key", ["required_cols", "null_check", "dateformatchecks", "no_negative_value"]
)
def test_unknown_column(spark, key):
    source = spark.createDataFrame([], "order_id string, customer_id string, status string, "
                                   "amount string, order_date string")
    with pytest.raises(ConfigError, match=f"{key}.*nowhere"):
        plan_gate(source, config(**{key: ["nowhere"]}))


def test_unknown_cast_column_and_type(spark):
    source = spark.createDataFrame([], "order_id string, customer_id string, status string, "
                                   "amount string, order_date string")
    with pytest.raises(ConfigError, match="nowhere"):
        plan_gate(source, config(cols_datatype=[{"nowhere": "int"}]))
    with pytest.raises(ConfigError, match="wholenumber"):
        plan_gate(source, config(cols_datatype=[{"amount": "wholenumber"}]))


RULELESS = {"null_check": [], "dateformatchecks": [], "no_negative_value": []}


def test_reason_column_in_the_source_is_refused(spark):
    source = spark.createDataFrame([], "a string, Reject_Reason string")
    with pytest.raises(ConfigError, match="reject_reason"):
        plan_gate(source, config(required_cols=["a"], **RULELESS))


def test_wrong_types_are_refused(spark):
    source = spark.createDataFrame([], "a boolean, b int")
    rules = {"null_check": [], "no_negative_value": ["a"], "dateformatchecks": ["b"]}
    with pytest.raises(ConfigError, match="not a number.*not a date"):
        plan_gate(source, config(required_cols=["a"], **rules))


def test_awkward_names(spark):
    """Dots, helper-like names, another case and back quotes all resolve."""
    source = spark.createDataFrame(
        [("1", "x", "2024-01-01", "-7", "k"), ("2", None, "2024-01-01", "7", "k")],
        "rn string, `a.b` string, orderdate1 string, copies string, c0 string",
    )
    gate = plan_gate(
        source,
        config(
            required_cols=["RN", "`a.b`", "orderdate1", "copies"],
            null_check=["a.b"],
            dateformatchecks=["orderdate1"],
            no_negative_value=["`copies`"],
            cols_datatype=[{"copies": "int", "Rn": "bigint"}],
        ),
    )
    assert gate.accepted().columns == ["RN", "a.b", "orderdate1", "copies"]
    assert gate.accepted().count() == 0
    assert gate.rejects().columns == [*source.columns, "reject_reason"]
    assert sorted(r.reject_reason for r in gate.rejects().collect()) == [
        "Negative Value",
        "Null Record",
    ]


def test_case_sensitive_session(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        source = spark.createDataFrame([("1",)], "A string")
        with pytest.raises(ConfigError, match="unknown column 'a'"):
            plan_gate(source, config(required_cols=["a"], **RULELESS))
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_semantics_name_is_checked(spark):
    source = spark.createDataFrame([("1",)], "a string")
    with pytest.raises(ValueError, match="semantics"):
        plan_gate(source, config(required_cols=["a"], **RULELESS), semantics="strict")


@pytest.mark.parametrize(
    "path, name",
    [
        ("/rules/orders.json", "orders"),
        ("/rules/orders.v2.json", "orders"),
        ("orders", "orders"),
        ("s3://b/x.y/", ""),
        ("/a.b/.hidden", ""),
    ],
)
def test_table_name(spark, path, name):
    assert paths.table_name(path) == name
    column = spark.createDataFrame([(path,)], "p string").select(
        paths.table_name_column(F.col("p"))
    )
    assert column.first()[0] == name


def test_dated_adds_no_separator():
    assert paths.dated("/x/orders", "2024") == "/x/orders2024"
    assert paths.dated("/x/", "") == "/x/"
