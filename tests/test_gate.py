"""The whole job: files in, files out."""

import json
from collections import Counter
from datetime import datetime
from pathlib import Path

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from sift import ConfigError, run_gate
from sift.__main__ import main
from sift.plans import gate as gate_module
from sift.plans import sizing
from sift.sources import scratch, tables
from workload.dirty_orders import dirty_orders, rule_document

DATE = "1998/08/10"
SF_DIR = "/root/testdata/sf0.001"


def multiset(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.fixture
def job(spark, tmp_path):
    """A landing folder and a rule file; returns the rule file's path."""
    document = rule_document(str(tmp_path))
    tables.write_csv(dirty_orders(spark, SF_DIR), document["sourcefile"] + DATE)
    rules = tmp_path / "orders.json"
    rules.write_text(json.dumps(document, indent=1))
    return str(rules)


def write_job(tmp_path, lines, **changes):
    document = rule_document(str(tmp_path)) | changes
    landing = Path(document["sourcefile"] + DATE)
    landing.mkdir(parents=True)
    (landing / "part.csv").write_text("\n".join(lines) + "\n")
    rules = tmp_path / "orders.json"
    rules.write_text(json.dumps(document))
    return str(rules)


HEADER = "order_id,customer_id,status,amount,order_date,priority"


def test_outputs(spark, job, tmp_path, ansi):
    result = run_gate(spark, job, DATE)
    assert result.table == "orders"
    assert result.metrics == {
        "sourcecount": 1599,
        "uniquecount": 1500,
        "rejectcount": 519,
        "writtencount": 1153,
        "overlap": 73,
        "largest": result.metrics["largest"],
    }
    accepted = spark.read.parquet(f"{tmp_path}/target/orders/{DATE}")
    assert accepted.dtypes == [
        ("order_id", "bigint"),
        ("customer_id", "bigint"),
        ("amount", "decimal(12,2)"),
        ("order_date", "date"),
    ]
    assert multiset(accepted) == multiset(result.accepted)
    assert accepted.count() == 1153
    rejects = spark.read.csv(f"{tmp_path}/pending/orders/{DATE}", header=True)
    assert rejects.columns == [*HEADER.split(","), "reject_reason"]
    assert rejects.count() == 519
    assert multiset(rejects) == multiset(result.rejects)
    record = spark.read.csv(f"{tmp_path}/audit/orders/{DATE}", header=True).collect()
    assert len(record) == 1
    assert record[0][:4] == ("orders", "1599", "519", "1153")
    assert len(list((tmp_path / "audit" / "orders" / DATE).glob("part-*"))) == 1
    assert datetime.fromisoformat(record[0].loadtimestamp) == result.loaded.replace(
        microsecond=result.loaded.microsecond // 1000 * 1000
    )
    assert result.audit.dtypes[-1] == ("loadtimestamp", "timestamp")


def test_rerun_gives_the_same_content(spark, job):
    first = run_gate(spark, job, DATE)
    before = multiset(first.accepted), multiset(first.rejects)
    again = run_gate(spark, job, DATE)
    assert (multiset(again.accepted), multiset(again.rejects)) == before
    assert again.metrics == first.metrics


def test_staging_is_removed(spark, job, monkeypatch):
    made = []
    real = scratch.scratch_path

    def remember(*args, **options):
        made.append(real(*args, **options))
        return made[-1]

    monkeypatch.setattr(gate_module, "scratch_path", remember)
    run_gate(spark, job, DATE)
    assert len(made) == 1
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        assert made[0].startswith(base)
    assert not Path(made[0]).exists()


def test_empty_source(spark, tmp_path):
    result = run_gate(spark, write_job(tmp_path, [HEADER]), DATE)
    assert result.accepted.count() == result.rejects.count() == 0
    row = result.audit.first()
    assert (row.sourcecount, row.rejectcount, row.writtencount) == (0, 0, 0)


def test_short_long_and_blank_fields(spark, tmp_path):
    """Short lines are padded with NULL, surplus fields dropped, '' is NULL."""
    lines = [
        HEADER,
        "1,10,O,5.00,2024-01-01,high,surplus",
        '2,"",O,5.00,2024-01-01,high',
        "3,30,O",
        "4,40,O,1.005,12:30,high",
    ]
    result = run_gate(spark, write_job(tmp_path, lines), DATE)
    assert sorted(r.order_id for r in result.accepted.collect()) == [1, 4]
    four = result.accepted.filter("order_id = 4").first()
    assert (str(four.amount), four.order_date) == ("1.01", None)
    assert sorted((r.order_id, r.reject_reason) for r in result.rejects.collect()) == [
        ("2", "Null Record"),
        ("3", "Incorrect Dateformat"),
    ]


def test_faithful_rejects_keep_blanks_and_empty_texts(spark, tmp_path):
    source = spark.createDataFrame(
        [("1", " z ", ""), ("2", None, "x")], "order_id string, status string, note string"
    )
    rules = tmp_path / "orders.json"
    document = rule_document(str(tmp_path)) | {
        "required_cols": ["order_id"],
        "null_check": ["status"],
        "no_negative_value": [],
        "dateformatchecks": ["note"],
        "cols_datatype": [],
    }
    rules.write_text(json.dumps(document))
    exact = run_gate(spark, str(rules), DATE, source=source, faithful_rejects=True)
    assert multiset(exact.rejects) == Counter(
        [
            ("1", " z ", "", "Incorrect Dateformat"),
            ("2", None, "x", "Null Record"),
            ("2", None, "x", "Incorrect Dateformat"),
        ]
    )
    trimmed = run_gate(spark, str(rules), DATE, source=source)
    assert ("1", "z", None, "Incorrect Dateformat") in multiset(trimmed.rejects)


def test_lost_tasks_change_nothing(spark, job, tmp_path):
    """Every source task gives up halfway through its first attempt."""
    lost = str(tmp_path / "lost")

    def fail_first_attempt(batches):
        for number, batch in enumerate(batches):
            if number and TaskContext.get().attemptNumber() == 0:
                Path(lost).touch()
                raise RuntimeError("lost")
            yield batch

    plain = run_gate(spark, job, DATE)
    before = multiset(plain.accepted), multiset(plain.rejects)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        orders = dirty_orders(spark, SF_DIR)
        flaky = orders.mapInPandas(fail_first_attempt, orders.schema)
        result = run_gate(spark, job, DATE, source=flaky)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert Path(lost).exists()
    assert result.metrics == plain.metrics
    assert (multiset(result.accepted), multiset(result.rejects)) == before


def test_typed_source(spark, job):
    typed = dirty_orders(spark, SF_DIR).withColumn(
        "amount", F.col("amount").cast("decimal(12,2)")
    )
    result = run_gate(spark, job, DATE, source=typed)
    # -0.50 is a negative number, where as text its integer part is not
    assert result.metrics["writtencount"] == 1122


def test_exact_semantics(spark, job):
    assert run_gate(spark, job, DATE, semantics="exact").metrics["rejectcount"] == 556


def test_bad_config_writes_nothing(spark, tmp_path):
    path = write_job(tmp_path, [HEADER, "1,1,O,1,2024-01-01,h"], null_check=["nowhere"])
    with pytest.raises(ConfigError):
        run_gate(spark, path, DATE)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["landing", "orders.json"]


def test_job_arguments(spark, job, tmp_path):
    main(["--config_filepath", job, "--processed_date", DATE])
    assert spark.read.parquet(f"{tmp_path}/target/orders/{DATE}").count() == 1153
    with pytest.raises(SystemExit):
        main(["--processed_date", DATE])


# --- scratch and sizing --------------------------------------------------


class FakeSession:
    def __init__(self, folder, master, context_folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = master
        self.getCheckpointDir = lambda: context_folder


def test_scratch_prefers_the_folder_the_cluster_names():
    session = FakeSession("hdfs://shared/ckpt", "yarn", "hdfs://other")
    path = scratch.scratch_path(session, "t")
    assert path.startswith("hdfs://shared/ckpt/sift/t-")
    assert path != scratch.scratch_path(session, "t")
    session = FakeSession(None, "yarn", "hdfs://other")
    assert scratch.scratch_path(session, "t").startswith("hdfs://other/sift/t-")


def test_scratch_falls_back_on_the_warehouse_not_on_the_machine():
    session = FakeSession(None, "yarn")
    session.conf["spark.sql.warehouse.dir"] = "s3://shared/warehouse"
    assert scratch.scratch_path(session, "t").startswith("s3://shared/warehouse/sift/t-")


TB = 1024**4
DEFAULT_SPLIT = 128 * sizing.MB


@pytest.mark.parametrize(
    "size, split, partitions",
    [
        (10, DEFAULT_SPLIT, 200),
        (TB, DEFAULT_SPLIT, 2_048),
        (10 * TB, 160 * sizing.MB, 20_480),
        (100 * TB, sizing.GB, 39_062),
    ],
)
def test_the_shuffle_fits_the_source(size, split, partitions):
    fit = sizing.shuffle_size(size, DEFAULT_SPLIT, 200)
    assert (fit.split_bytes, fit.partitions) == (split, partitions)
    maps = -(-size // fit.split_bytes)
    assert maps * fit.partitions <= sizing.SHUFFLE_BLOCKS


def test_given_settings_are_never_lowered():
    fit = sizing.shuffle_size(TB, 2 * sizing.GB, 5_000)
    assert (fit.split_bytes, fit.partitions) == (2 * sizing.GB, 5_000)


SETTINGS = (sizing.SHUFFLE_PARTITIONS, sizing.OPEN_WRITERS, sizing.SPLIT_SIZE)


def test_settings_hold_only_for_the_job(spark, monkeypatch):
    source = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    size = Path(f"{SF_DIR}/lineitem.parquet").stat().st_size
    assert sizing.estimated_bytes(source) == size
    before = [spark.conf.get(key) for key in SETTINGS]
    with sizing.staging_settings(spark, source):
        assert spark.conf.get(SETTINGS[0]) == before[0]
        assert int(spark.conf.get(SETTINGS[1])) >= 2
    assert [spark.conf.get(key) for key in SETTINGS] == before
    monkeypatch.setattr(sizing, "PARTITION_BYTES", size // 50)
    with pytest.raises(KeyError):
        with sizing.staging_settings(spark, source):
            assert int(spark.conf.get(SETTINGS[0])) > 50
            raise KeyError
    assert [spark.conf.get(key) for key in SETTINGS] == before


def test_runs_that_overlap_fail_at_once(spark):
    source = spark.read.parquet(f"{SF_DIR}/region.parquet")
    with sizing.staging_settings(spark, source):
        with pytest.raises(RuntimeError, match="overlap"):
            with sizing.staging_settings(spark, source):
                pass
    with sizing.staging_settings(spark, source):
        pass


def test_size_of_a_join_is_not_a_product(spark):
    size = {name: Path(f"{SF_DIR}/{name}.parquet").stat().st_size for name in ("orders", "customer")}
    orders, customer = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in size)
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    assert 0 < sizing.estimated_bytes(joined) <= sum(size.values())


def test_an_unknown_size_is_told_or_warned_of(spark):
    unknown = spark.sparkContext.parallelize([(1,)]).toDF(["a"])
    assert sizing.estimated_bytes(unknown) is None
    before = [spark.conf.get(key) for key in SETTINGS]
    with pytest.warns(UserWarning, match="source_bytes"):
        with sizing.staging_settings(spark, unknown):
            assert spark.conf.get(SETTINGS[0]) == before[0]
    with sizing.staging_settings(spark, unknown, TB):
        assert spark.conf.get(SETTINGS[0]) == "2048"
    assert [spark.conf.get(key) for key in SETTINGS] == before


# --- staging apart from the outputs, checks before the first job ----------


@pytest.mark.parametrize("below", ["target", "pending"])
def test_an_audit_below_another_output(spark, tmp_path, below):
    document = rule_document(str(tmp_path))
    document["auditfile"] = document[f"{below}file"] + DATE + "/audit/"
    tables.write_csv(dirty_orders(spark, SF_DIR), document["sourcefile"] + DATE)
    (tmp_path / "orders.json").write_text(json.dumps(document))
    result = run_gate(spark, str(tmp_path / "orders.json"), DATE)
    assert spark.read.csv(result.paths.audit, header=True).count() == 1
    assert result.accepted.count() == 1153 and result.rejects.count() == 519


def test_staging_inside_an_output_is_refused(spark, job, tmp_path, monkeypatch):
    for inside in (f"{tmp_path}/target/orders/{DATE}/x", f"file:{tmp_path}/landing/orders/{DATE}", f"{tmp_path}"):
        monkeypatch.setattr(gate_module, "scratch_path", lambda *a, inside=inside: inside)
        with pytest.raises(ConfigError, match="overlap"):
            run_gate(spark, job, DATE)
    assert not (tmp_path / "target").exists()


@pytest.mark.parametrize(
    "column, cast, message",
    [
        ("'a' AS v", "array<int>", "accepted rows"),
        ("DATE'2024-01-01' AS v", "int", "accepted rows"),
        ("'a' AS v", "x int", "no type name"),
        ("array(1) AS v", None, "reject ledger"),
        ("map('a', 1) AS v", None, "reject ledger"),
    ],
)
def test_outputs_are_checked_before_any_job(spark, tmp_path, monkeypatch, column, cast, message):
    document = rule_document(str(tmp_path)) | {
        "required_cols": ["id"],
        "null_check": ["id"],
        "no_negative_value": [],
        "dateformatchecks": [],
        "cols_datatype": [{"v": cast}] if cast else [],
    }
    (tmp_path / "t.json").write_text(json.dumps(document))
    monkeypatch.setattr(gate_module, "staging_settings", None)  # staging would fail otherwise
    source = spark.sql(f"SELECT '1' AS id, {column}")
    with pytest.raises(ConfigError, match=message):
        run_gate(spark, str(tmp_path / "t.json"), DATE, source=source)
    assert [p.name for p in tmp_path.iterdir()] == ["t.json"]


ODD_TEXTS = ["a\nb", "\r\n", "\\N", "~N", "~0~1", "~", '"', '\\"', '""', "\\", "a,b", " z ", "", None, "\t",
             "'", "#", "line\rbreak", '"a\n"', "~\n~"]


def test_faithful_csv_brings_back_every_text(spark, tmp_path):
    rows = [(i, t, u) for i, (t, u) in enumerate(zip(ODD_TEXTS, ODD_TEXTS[::-1]))]
    df = spark.createDataFrame(rows, "n int, t string, `odd name` string")
    tables.write_csv(df, str(tmp_path / "out"), faithful=True)
    back = tables.read_csv(spark, str(tmp_path / "out"), schema=df.schema, faithful=True)
    assert sorted(map(tuple, back.collect())) == rows


def test_all_columns(spark, tmp_path):
    rules = write_job(
        tmp_path,
        [HEADER, "1,2,O,3.5,2024-01-01,h"],
        required_cols=["*"],
    )
    assert run_gate(spark, rules, DATE).accepted.columns == HEADER.split(",")
    rules = json.loads(Path(rules).read_text()) | {"required_cols": ["*", "order_id"]}
    (tmp_path / "orders.json").write_text(json.dumps(rules))
    with pytest.raises(ConfigError, match="twice"):
        run_gate(spark, str(tmp_path / "orders.json"), DATE)
