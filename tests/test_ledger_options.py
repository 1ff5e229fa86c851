"""Malformed lines, keys, explained failures, lost values, and folders of rule files."""

import json
from collections import Counter
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sift import ConfigError, GateConfig, load_folder, plan_gate, run_folder, run_gate
from sift.operators import tally as tallies
from sift.sources import tables
from workload.dirty_orders import dirty_orders, orders_config, rule_document

DATE = "1998/08/10"
SF_DIR = "/root/testdata/sf0.001"


def config(**changes) -> GateConfig:
    return GateConfig("", "", "", "", **({"required_cols": ("*",)} | changes))


def multiset(df):
    return Counter(tuple(row) for row in df.collect())


# --- malformed lines -------------------------------------------------------

LINES = [
    "id,name,note",
    "1,a,x",
    "2,b",
    "2,b,",
    "3,c,z,more",
    "3,c,z,more",
    "3,c,z,other",
    "3,c,z",
    ",d",
    '4,"e,f",y',
]


def test_short_and_long_lines(spark, tmp_path):
    (tmp_path / "t.csv").write_text("\n".join(LINES) + "\n")
    plain = plan_gate(tables.read_csv(spark, str(tmp_path)), config(null_check=("id",)))
    assert plain.accepted().count() == 4  # the default fills up and cuts off
    source = tables.read_csv(spark, str(tmp_path), malformed="line")
    assert source.columns == ["id", "name", "note", "line"]
    gate = plan_gate(source, config(null_check=("id",)), malformed="line")
    assert gate.accepted().columns == ["id", "name", "note"]
    assert multiset(gate.accepted()) == Counter([("1", "a", "x"), ("2", "b", None), ("3", "c", "z"), ("4", "e,f", "y")])
    assert multiset(gate.rejects()) == Counter(
        [
            ("2", "b", None, "2,b", "Malformed record"),
            ("3", "c", "z", "3,c,z,more", "Duplicate record"),
            ("3", "c", "z", "3,c,z,more", "Malformed record"),
            ("3", "c", "z", "3,c,z,other", "Malformed record"),
            (None, "d", None, ",d", "Malformed record"),
            (None, "d", None, ",d", "Null Record"),
        ]
    )
    counts = gate.counts().first()
    assert (counts.sourcecount, counts.rejectcount, counts.writtencount, counts.overlap) == (9, 6, 4, 1)


def test_the_job_rejects_malformed_lines_on_demand(spark, tmp_path):
    document = rule_document(str(tmp_path)) | {
        "required_cols": ["id", "note"], "null_check": [], "no_negative_value": [], "dateformatchecks": [], "cols_datatype": []
    }
    landing = Path(document["sourcefile"] + DATE)
    landing.mkdir(parents=True)
    (landing / "a.csv").write_text("\n".join(LINES))
    (landing / "b.csv").write_text("id,name,note\n7,g\n8,h,i\n")
    (tmp_path / "t.json").write_text(json.dumps(document))
    result = run_gate(spark, str(tmp_path / "t.json"), DATE, reject_malformed=True)
    assert result.accepted.columns == ["id", "note"]
    assert ("7", "g", None, "7,g", "Malformed record") in multiset(result.rejects)
    assert result.metrics["writtencount"] == 5 and result.metrics["sourcecount"] == 11
    assert run_gate(spark, str(tmp_path / "t.json"), DATE).rejects.columns[-1] == "reject_reason"


# --- keys --------------------------------------------------------------------

ROWS = [
    ("a", "1", "x"), ("a", "1", "x"), ("a", "10", "y"), ("a", "9", "z"),
    (None, "3", "p"), (None, "4", None), (None, None, "q"),
    ("b", "-5", "worse"), ("b", "2", "only"), ("c", "-1", "none passes"),
    ("d", "7", "same"), ("d", "7", "tie"),
]


def keyed(spark, **options):
    source = spark.createDataFrame(ROWS, "k string, n string, t string").repartition(3)
    rules = config(no_negative_value=("n",), duplicate_check=["k"], cols_datatype={"n": "int"})
    return plan_gate(source, rules, **options)


def test_one_row_per_key(spark, ansi):
    gate = keyed(spark, latest_by=["n"])
    # compared as the declared type: 10 is more than 9; ties go to the larger row
    assert multiset(gate.accepted()) == Counter(
        [("a", 10, "y"), (None, 4, None), ("b", 2, "only"), ("d", 7, "tie")]
    )
    assert multiset(gate.rejects()) == Counter(
        [
            ("a", "1", "x", "Duplicate record"), ("a", "1", "x", "Duplicate key"), ("a", "9", "z", "Duplicate key"),
            (None, "3", "p", "Duplicate key"), (None, None, "q", "Duplicate key"),
            ("b", "-5", "worse", "Negative Value"), ("c", "-1", "none passes", "Negative Value"),
            ("d", "7", "same", "Duplicate key"),
        ]
    )
    counts = gate.counts().first()
    assert counts.sourcecount == counts.rejectcount + counts.writtencount - counts.overlap == 12


def test_keys_are_inert_by_default(spark):
    assert keyed(spark).accepted().count() == 9
    assert "Duplicate key" not in {r.reject_reason for r in keyed(spark).rejects().collect()}


def test_keys_of_several_columns_and_no_order(spark):
    source = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 2, "x"), (None, 1, "x")], "k string, `my n` int, t string")
    gate = plan_gate(source, config(duplicate_check=["K", "`my n`", "k"]), latest_by=[])
    assert multiset(gate.accepted()) == Counter([("a", 1, "y"), ("a", 2, "x"), (None, 1, "x")])


def test_staged_keys_give_the_same(spark, tmp_path):
    lazy = keyed(spark, latest_by=["n"], explain=True)
    stored = lazy.stage(str(tmp_path / "t"))
    assert multiset(stored.accepted()) == multiset(lazy.accepted())
    assert multiset(stored.rejects()) == multiset(lazy.rejects())
    assert stored.metrics() == lazy.counts().first().asDict()


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    source = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("n")
    )
    gate = plan_gate(source, config(duplicate_check=["k"]), latest_by=["n"])
    assert gate.accepted().filter("k = 'hot'").first().n == 29_999
    assert gate.accepted().count() == 10_001
    plan = gate.accepted()._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


@pytest.mark.parametrize("listed, order", [([], ["n"]), ("k", ["n"]), (None, []), (["nowhere"], []), (["k"], ["nowhere"]), ([1], [])])
def test_wrong_keys(spark, listed, order):
    source = spark.createDataFrame(ROWS, "k string, n string, t string")
    with pytest.raises(ConfigError):
        plan_gate(source, config(duplicate_check=listed), latest_by=order)


def test_the_job_with_keys(spark, tmp_path):
    document = rule_document(str(tmp_path)) | {"duplicate_check": ["customer_id"]}
    tables.write_csv(dirty_orders(spark, SF_DIR), document["sourcefile"] + DATE)
    (tmp_path / "orders.json").write_text(json.dumps(document))
    result = run_gate(spark, str(tmp_path / "orders.json"), DATE, latest_by=["order_date"], explain=True)
    customers = [r.customer_id for r in result.accepted.collect()]
    assert len(customers) == len(set(customers)) == result.metrics["writtencount"]
    assert result.rejects.count() == result.metrics["rejectcount"]
    assert result.rejects.filter("reject_check = 'duplicate_check'").count() == 1153 - len(customers)


# --- explained failures --------------------------------------------------------


def test_explained_ledger(spark, ansi):
    gate = plan_gate(dirty_orders(spark, SF_DIR), orders_config(), explain=True)
    ledger = gate.rejects()
    assert ledger.columns[-3:] == ["reject_reason", "reject_check", "reject_column"]
    plain = plan_gate(dirty_orders(spark, SF_DIR), orders_config()).rejects()
    rows = "Exchange hashpartitioning(c0"
    shuffles = [d._jdf.queryExecution().executedPlan().toString().count(rows) for d in (ledger, plain)]
    assert shuffles[0] == shuffles[1]
    assert multiset(ledger.drop("reject_check", "reject_column")) == multiset(plain)
    status = ledger.filter("reject_column = 'status'")
    assert status.count() > 0 and status.filter("status IS NOT NULL OR reject_check != 'null_check'").isEmpty()
    assert ledger.filter("(reject_reason = 'Duplicate record') != (reject_check IS NULL)").isEmpty()


@pytest.mark.parametrize("key", [None, []])
def test_more_rules_than_an_integer_has_bits(spark, monkeypatch, key):
    monkeypatch.setattr(tallies, "BITS", 3)
    names = [f"n{at}" for at in range(9)]
    row = [None if at % 2 == 0 else "x" for at in range(len(names))]
    source = spark.createDataFrame([row, ["x"] * 9, ["x"] * 8 + ["y"]], ", ".join(f"{n} string" for n in names))
    gate = plan_gate(source, config(null_check=tuple(names), duplicate_check=["n1"]), explain=True, latest_by=key)
    found = [r.reject_column for r in gate.rejects().collect()]
    assert sorted(found) == sorted(names[::2] + ([] if key is None else ["n1"]))


def test_many_rules_are_planned_in_time(spark):
    names = [f"n{at}" for at in range(40)]
    source = spark.createDataFrame([["x"] * 40], ", ".join(f"{n} string" for n in names))
    gate = plan_gate(source, config(null_check=tuple(names), duplicate_check=["n1"]), explain=True, latest_by=[])
    assert gate.rejects().isEmpty() and gate.accepted().count() == 1


def test_an_explained_ledger_without_rules(spark):
    source = spark.createDataFrame([("a",), ("a",)], "k string")
    gate = plan_gate(source, config(), explain=True)
    assert [tuple(r) for r in gate.rejects().collect()] == [("a", "Duplicate record", None, None)]
    with pytest.raises(ConfigError, match="reject_check"):
        plan_gate(source.withColumnRenamed("k", "Reject_Check"), config(), explain=True)


# --- lost values ------------------------------------------------------------------


def test_cast_losses(spark, ansi):
    rows = [("1", "2024-01-01"), ("x", "2024-01-01"), ("x", "12:30"), (None, "nonsense"), ("99999999999", None)]
    source = spark.createDataFrame(rows, "n string, `the day` string")
    rules = config(dateformatchecks=("the day",), cols_datatype={"n": "int", "`the day`": "date"})
    gate = plan_gate(source, rules)
    assert [tuple(r) for r in gate.cast_losses().collect()] == [("n", "int", 2), ("the day", "date", 1)]
    assert plan_gate(source, config()).cast_losses().collect() == []
    empty = plan_gate(source.limit(0), rules).cast_losses()
    assert [r.losses for r in empty.collect()] == [0, 0]


# --- folders of rule files -----------------------------------------------------------


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "rules").mkdir()

    def put(name, document):
        text = document if isinstance(document, str) else json.dumps(document, indent=1)
        (tmp_path / "rules" / name).write_text(text)

    put("orders.v2.json", rule_document(str(tmp_path)))
    other = rule_document(str(tmp_path / "other")) | {"required_cols": ["*"], "null_check": ["c_name"]}
    other |= {"dateformatchecks": [], "no_negative_value": ["c_acctbal"], "cols_datatype": []}
    put("customer.json", [other, "ignored"])
    put("readme.txt", "no rule file")
    return tmp_path, put


def test_rule_files_of_a_folder(spark, folder):
    root, _ = folder
    configs = load_folder(spark, str(root / "rules"))
    assert list(configs) == ["customer", "orders"]
    assert configs["orders"] == replace(orders_config(str(root)), duplicate_check=[])
    assert configs["customer"].cols_datatype == {} and configs["customer"].null_check == ("c_name",)


def test_all_tables_of_a_folder(spark, folder):
    root, _ = folder
    tables.write_csv(dirty_orders(spark, SF_DIR), rule_document(str(root))["sourcefile"] + DATE)
    customers = spark.read.parquet(f"{SF_DIR}/customer.parquet")
    results = run_folder(spark, str(root / "rules"), DATE, sources={"customer": customers})
    assert results["orders"].metrics["writtencount"] == 1153
    assert results["customer"].accepted.count() == customers.filter("c_acctbal >= 0").count()


def test_one_failing_table_does_not_stop_the_others(spark, folder):
    root, _ = folder
    customers = spark.read.parquet(f"{SF_DIR}/customer.parquet")
    with pytest.raises(ExceptionGroup, match="1 of 2 tables") as caught:
        run_folder(spark, str(root / "rules"), DATE, sources={"customer": customers})
    assert caught.value.exceptions[0].__notes__ == ["table orders"]
    assert spark.read.parquet(f"{root}/other/target/orders/{DATE}").count() > 0


def test_wrong_rule_files_come_together(spark, folder):
    root, put = folder
    put("bad.json", "{not json")
    put("empty.json", "[]")
    put("orders.json", rule_document())
    put("short.json", {"sourcefile": "x"})
    with pytest.raises(ConfigError) as caught:
        load_folder(spark, str(root / "rules"))
    for part in ("bad.json: no rule document", "empty.json: no rule document", "second file for table 'orders'", "short.json: missing key"):
        assert part in str(caught.value)
    (root / "none").mkdir()
    with pytest.raises(ConfigError, match="no rule files"):
        load_folder(spark, str(root / "none"))
