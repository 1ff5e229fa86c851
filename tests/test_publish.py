"""The three outputs take their places together, and are counted while they are staged."""

import json
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark import TaskContext

from sift import ConfigError, plan_gate, run_gate
from sift.__main__ import main
from sift.operators import audit
from sift.plans import gate as gate_module
from sift.plans.gate import Gate
from sift.sources import publish, scratch, tables
from workload.dirty_orders import dirty_orders, orders_config, rule_document

DATE = "1998/08/10"
SF_DIR = "/root/testdata/sf0.001"
OUTPUTS = ("target", "pending", "audit")


def write_job(root, rows, **changes):
    """A rule file and a landing folder with these (id, amount) lines."""
    document = rule_document(str(root)) | changes
    landing = Path(document["sourcefile"] + DATE)
    landing.mkdir(parents=True, exist_ok=True)
    lines = [f"{i},1,O,{amount},2024-01-01,high" for i, amount in rows]
    (landing / "part.csv").write_text("\n".join(["order_id,customer_id,status,amount,order_date,priority", *lines]))
    (root / "orders.json").write_text(json.dumps(document))
    return str(root / "orders.json")


def files(root) -> dict[str, bytes]:
    """Everything below the outputs, hidden folders and journals included."""
    found = {}
    for name in OUTPUTS:
        for path in sorted((root / name).rglob("*")):
            if path.is_file() and not path.name.endswith(".crc"):
                found[str(path.relative_to(root))] = path.read_bytes()
    return found


def hidden(root) -> list[str]:
    return [str(p) for name in OUTPUTS for p in (root / name).rglob(".*") if not p.name.endswith(".crc")]


def fail_at(monkeypatch, target, name, call):
    """Let the call-th call of a function fail after its work is done."""
    real, calls = getattr(target, name), []

    def wrapped(*args, **options):
        calls.append(None)
        made = real(*args, **options)
        if len(calls) == call:
            raise OSError("cut off")
        return made

    monkeypatch.setattr(target, name, wrapped)


@pytest.mark.parametrize("writer, call", [("write_parquet", 1), ("write_csv", 1), ("write_csv", 2)])
def test_a_failed_write_leaves_the_old_outputs(spark, tmp_path, monkeypatch, writer, call):
    rules = write_job(tmp_path, [(1, 5), (2, -5)])
    run_gate(spark, rules, DATE)
    before = files(tmp_path)
    write_job(tmp_path, [(3, 7), (4, 8), (5, -9)])
    with monkeypatch.context() as patch:
        fail_at(patch, tables, writer, call)
        with pytest.raises(OSError, match="cut off"):
            run_gate(spark, rules, DATE)
    assert files(tmp_path) == before and hidden(tmp_path) == []
    result = run_gate(spark, rules, DATE)
    assert sorted(r.order_id for r in result.accepted.collect()) == [3, 4]
    assert hidden(tmp_path) == []


@pytest.mark.parametrize("call", [1, 2, 3])
def test_moves_that_were_cut_off_are_made_up_for(spark, tmp_path, monkeypatch, call):
    rules = write_job(tmp_path, [(1, 5), (2, -5)])
    run_gate(spark, rules, DATE)
    write_job(tmp_path, [(3, 7), (4, 8), (5, -9)])
    with monkeypatch.context() as patch:
        fail_at(patch, publish, "move", call)
        with pytest.raises(OSError, match="cut off"):
            run_gate(spark, rules, DATE)
    outputs = [rule_document(str(tmp_path))[f"{name}file"] + DATE for name in OUTPUTS]
    journal = publish.journal_path(outputs)
    assert Path(journal).exists()
    assert publish.finish(spark, journal) and not publish.finish(spark, journal)
    assert hidden(tmp_path) == []
    assert sorted(r.order_id for r in spark.read.parquet(outputs[0]).collect()) == [3, 4]
    assert [r.order_id for r in tables.read_csv(spark, outputs[1]).collect()] == ["5"]
    assert tables.read_csv(spark, outputs[2]).first().writtencount == "2"


def test_the_next_run_makes_the_moves_first(spark, tmp_path, monkeypatch):
    rules = write_job(tmp_path, [(1, 5)])
    with monkeypatch.context() as patch:
        fail_at(patch, publish, "move", 1)
        with pytest.raises(OSError):
            run_gate(spark, rules, DATE)
    # the run fails before it writes, but has finished the one before
    with monkeypatch.context() as patch:
        patch.setattr(gate_module, "staging_settings", None)
        with pytest.raises(TypeError):
            run_gate(spark, rules, DATE)
    assert tables.read_csv(spark, rule_document(str(tmp_path))["auditfile"] + DATE).count() == 1
    assert hidden(tmp_path) == []


def test_two_outputs_in_one_place_are_refused(spark, tmp_path):
    rules = write_job(tmp_path, [(1, 5)], auditfile=f"file:{tmp_path}/target/orders/")
    with pytest.raises(ConfigError, match="two outputs"):
        run_gate(spark, rules, DATE)


def test_places_of_outputs_inside_each_other(spark):
    new = publish.Publication(spark, ["/a/t/d", "/a/t/d/audit/d", "/b/p/"])
    assert list(new.moves) == ["/b/p/", "/a/t/d", "/a/t/d/audit/d"]
    assert new.place("/a/t/d/audit/d").startswith("/a/t/.d-")
    assert new.place("/b/p/").startswith("/b/.p-")
    assert len(set(new.moves.values())) == 3
    assert publish.plain("file:///x/y") == publish.plain("/x/y/") == "/x/y/"


# --- counted while staged -------------------------------------------------


def test_counting_takes_no_job_of_its_own(spark, tmp_path, monkeypatch):
    rules = write_job(tmp_path, [(1, 5), (1, 5), (2, -5), (3, "x")])
    monkeypatch.setattr(Gate, "counts", None)
    monkeypatch.setattr(Gate, "cast_losses", None)
    result = run_gate(spark, rules, DATE)
    assert result.metrics == {
        "sourcecount": 4, "uniquecount": 3, "rejectcount": 2, "writtencount": 2, "overlap": 0, "largest": 1
    }
    assert result.cast_losses == {"order_id": 0, "customer_id": 0, "amount": 1, "order_date": 0}


def test_what_was_not_observed_is_counted_by_a_job(spark, tmp_path):
    gate = plan_gate(dirty_orders(spark, SF_DIR), orders_config())
    stored = gate.stage(str(tmp_path / "t"))
    unseen = replace(stored, tally=replace(stored.tally, counted={}))
    assert unseen.metrics() == stored.metrics() == gate.counts().first().asDict()
    assert unseen.losses() == stored.losses()


def test_tries_of_writing_tasks_count_once(spark, tmp_path):
    """Every task of the counted write gives up halfway through its first attempt."""
    lost = str(tmp_path / "lost")

    def fail_first_attempt(batches):
        for number, batch in enumerate(batches):
            yield batch
            if number and TaskContext.get().attemptNumber() == 0:
                Path(lost).touch()
                raise RuntimeError("lost")

    gate = plan_gate(dirty_orders(spark, SF_DIR), orders_config())
    plain = gate.stage(str(tmp_path / "plain")).metrics()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        frame = gate.tally.frame.mapInPandas(fail_first_attempt, gate.tally.frame.schema)
        stored = replace(gate.tally, frame=frame).stage(str(tmp_path / "t"), audit.count_columns())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert Path(lost).exists()
    assert stored.counted == plain == gate.counts().first().asDict()
    assert stored.frame.count() == plain["uniquecount"]


# --- staging ---------------------------------------------------------------


class Session:
    def __init__(self, master, **conf):
        self.conf, self.sparkContext, self.master = conf, self, master
        self.getCheckpointDir = lambda: None


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[3,2,1024]"])
def test_a_machine_local_warehouse_is_refused_on_a_cluster(master):
    here = {"spark.sql.warehouse.dir": "file:/home/me/spark-warehouse"}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_path(Session(master, **here), "t")
    for local in ("local", "local[8]", "local[8,3]", "local[*]"):
        assert scratch.scratch_path(Session(local, **here), "t").startswith("file:/home/me/")
    # a folder that the cluster names is its own word that all machines share it
    named = here | {"spark.checkpoint.dir": "file:///mnt/shared"}
    assert scratch.scratch_path(Session(master, **named), "t").startswith("file:///mnt/shared/")


def test_the_refusal_comes_before_any_job(spark, tmp_path, monkeypatch):
    rules = write_job(tmp_path, [(1, 5)])

    def refuse(session, label):
        return scratch.scratch_path(Session("yarn", **{"spark.sql.warehouse.dir": "file:/w"}), label)

    monkeypatch.setattr(gate_module, "scratch_path", refuse)
    monkeypatch.setattr(gate_module, "staging_settings", None)  # staging would fail otherwise
    with pytest.raises(RuntimeError, match="one machine's own"):
        run_gate(spark, rules, DATE)
    assert not (tmp_path / "target").exists()
    assert scratch.scheme_of(spark, "/x") == "file" and scratch.scheme_of(spark, "HDFS://x/y") == "hdfs"


def test_job_arguments_reach_the_run(monkeypatch):
    from sift import __main__ as job

    seen = []
    monkeypatch.setattr(job, "run_gate", lambda *args, **options: seen.append((args[1:], options)))
    monkeypatch.setattr(job, "run_folder", lambda *args, **options: seen.append((args[1:], options)))
    main(["--config_filepath", "/r.json", "--processed_date", "d", "--explain", "--latest_by", "a,b"])
    main(["--config_folder", "/rules", "--unknown_keys", "pass", "--source_bytes", "5", "--faithful_rejects"])
    assert seen[0][0] == ("/r.json", "d") and seen[1][0] == ("/rules", "")
    assert seen[0][1]["explain"] and seen[0][1]["latest_by"] == ["a", "b"] and seen[0][1]["strict"]
    assert seen[1][1]["latest_by"] is None and not seen[1][1]["strict"]
    assert seen[1][1]["source_bytes"] == 5 and seen[1][1]["faithful_rejects"]
    for wrong in ([], ["--config_filepath", "/r", "--config_folder", "/f"]):
        with pytest.raises(SystemExit):
            main(wrong)
