"""Pipeline: logging, stop at first failure, versioned overwrite, single-step rerun."""

from pyspark.sql import functions as F

from tallyhouse import constants as C
from tallyhouse.plans.pipeline import Step, StepFailed, read_log, run_pipeline
from tallyhouse.session import scratch_path
from tallyhouse.sources.sinks import overwrite, read_current


def _boom(w):
    raise StepFailed("broken input")


def test_stops_at_first_failure_and_names_phase(spark):
    base = scratch_path(spark, "pipe-test")
    steps = [Step("a", "1-staging", lambda w: spark.range(3)),
             Step("b", "2-dimensions", _boom),
             Step("c", "3-facts", lambda w: spark.range(5))]
    log = run_pipeline(spark, "/nonexistent", base, steps=steps, warehouse=object()).collect()
    assert [(r["step"], r["status"], r["rows_written"]) for r in log] == [
        ("a", C.SUCCEEDED, 3), ("b", C.FAILED, None)]
    assert "phase 2-dimensions, step b" in log[1]["message"]
    assert read_current(spark, f"{base}/a").count() == 3
    # the log is appended, not overwritten
    run_pipeline(spark, "/nonexistent", base, steps=steps[:1], warehouse=object())
    assert read_log(spark, base).count() == 5  # two runs, three steps


def test_failed_check_keeps_previous_version(spark):
    base = scratch_path(spark, "pipe-check")
    ok = Step("t", "3-facts", lambda w: spark.range(2))
    run_pipeline(spark, "/x", base, steps=[ok], warehouse=object())
    bad = Step("t", "3-facts", lambda w: spark.range(9), check=lambda w, df: df.where(F.col("id") > 5))
    log = run_pipeline(spark, "/x", base, steps=[bad], warehouse=object()).collect()
    assert log[0]["status"] == C.FAILED
    assert read_current(spark, f"{base}/t").count() == 2


def test_versioned_overwrite_reads_committed(spark):
    base = scratch_path(spark, "versions")
    overwrite(spark.range(4), base)
    first = read_current(spark, base)
    overwrite(spark.range(7), base)
    assert first.count() == 4            # old version still readable
    assert read_current(spark, base).count() == 7


def test_failed_write_keeps_the_committed_version(spark):
    base = scratch_path(spark, "atomic")
    overwrite(spark.range(4), base)
    try:
        overwrite(spark.range(3).select(F.expr("assert_true(id < 2)").alias("x")), base)
    except Exception:
        pass
    assert read_current(spark, base).count() == 4


def test_log_ids_go_on_from_run_to_run(spark):
    from tallyhouse.plans.pipeline import latest_first
    base = scratch_path(spark, "log-ids")
    steps = [Step("a", "1-staging", lambda w: spark.range(3)), Step("b", "2-dimensions", lambda w: spark.range(1))]
    for _ in range(2):
        run_pipeline(spark, "/nonexistent", base, steps=steps, warehouse=object())
    log = latest_first(read_log(spark, base))
    assert [(r["log_id"], r["step"]) for r in log.collect()] == [
        (6, "b"), (5, "a"), (4, "pipeline"), (3, "b"), (2, "a"), (1, "pipeline")]
    assert {r["status"] for r in log.collect()} == {C.SUCCEEDED}
    assert spark.read.parquet(f"{base}/_log").filter(F.col("status") == C.RUNNING).count() == 6


def test_a_run_that_dies_leaves_its_open_step(spark):
    base = scratch_path(spark, "log-open")

    def dies(w):
        raise KeyboardInterrupt
    try:
        run_pipeline(spark, "/nonexistent", base, steps=[Step("a", "1-staging", dies)], warehouse=object())
    except KeyboardInterrupt:
        pass
    assert [(r["step"], r["status"]) for r in read_log(spark, base).orderBy("log_id").collect()] == [
        ("pipeline", C.RUNNING), ("a", C.RUNNING)]


def test_cluster_without_shared_folder_is_refused():
    from types import SimpleNamespace

    import pytest

    from tallyhouse.session import ensure_checkpoint_dir
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None,
                             getConf=lambda: SimpleNamespace(get=lambda k, d=None: d))
        fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(fake)


def test_run_step_rebuilds_one_table(spark):
    from tallyhouse.plans.pipeline import run_step
    base = scratch_path(spark, "rerun")
    log = run_step(spark, "/root/testdata/sf0.001", base, "dim_store").collect()
    assert [(r["step"], r["status"]) for r in log] == [("dim_store", C.SUCCEEDED)]
    assert read_current(spark, f"{base}/dim_store").count() == log[0]["rows_written"] > 0


def test_dedup_first_keeps_first_row(spark):
    from tallyhouse.operators.aggregate import dedup_first
    df = spark.createDataFrame([(1, 3, "c"), (1, 2, "b"), (2, 9, "z"), (None, 1, "n"), (None, 0, "m")],
                               "k int, o int, v string")
    got = sorted(map(tuple, dedup_first(df, ["k"], ["o"]).collect()), key=str)
    assert got == sorted([(1, 2, "b"), (2, 9, "z"), (None, 0, "m")], key=str)
