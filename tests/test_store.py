"""Stored tables: commits, manifests, dimensions kept from run to run, single steps."""

import os
import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyhouse import constants as C
from tallyhouse.operators.scd2 import scd2_apply, scd2_load
from tallyhouse.plans.pipeline import Step, read_log, run_pipeline, run_step
from tallyhouse.plans.queries import QUERIES, stored_warehouse
from tallyhouse.session import scratch_path
from tallyhouse.sources.commits import commits, listing, publish, publish_next, read_commit
from tallyhouse.sources.sinks import Conflict, Manifest, Store, Version, overwrite, read_current

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return Counter(map(tuple, df.select(sorted(df.columns)).collect()))


def test_a_number_is_given_once(spark):
    base = scratch_path(spark, "race")
    got, ready = [], threading.Barrier(8)

    def writer(name):
        ready.wait()
        got.append((publish(spark, base, 1, name), name))

    threads = [threading.Thread(target=writer, args=(f"w{i}",)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    winners = [n for ok, n in got if ok]
    assert len(winners) == 1 and read_commit(spark, commits(spark, base)[1]) == winners[0]
    assert publish_next(spark, base, "next") == 2
    assert {p.rsplit("/", 1)[-1][0] for p, _, _ in listing(spark, base)} <= {"0"}  # no drafts left


def test_racing_table_writers_both_commit(spark):
    base = scratch_path(spark, "race-table")
    threads = [threading.Thread(target=overwrite, args=(spark.range(n), base)) for n in (3, 4, 5)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(commits(spark, f"{base}/_commits")) == [1, 2, 3]
    assert read_current(spark, base).count() in (3, 4, 5)


def test_two_runs_from_one_state_cannot_both_commit(spark):
    store = Store(spark, scratch_path(spark, "conflict"))
    first = store.commit(store.latest(), {"t": Version({"all": ["a"]})})
    store.commit(first, {"t": Version({"all": ["b"]})})
    with pytest.raises(Conflict):
        store.commit(first, {"u": Version({"all": ["c"]}, 7)})
    assert store.latest() == Manifest(2, {"t": Version({"all": ["b"]})})
    assert store.at(1) == first


def test_a_reader_sees_the_old_state_until_the_run_ends(spark):
    base = scratch_path(spark, "reader")
    store, seen = Store(spark, base), []

    def look(w):
        now = store.latest()
        seen.append({n: store.read(n, v).count() for n, v in now.tables.items()})
        return spark.range(1)

    def steps(n, last):
        return [Step("a", "1-staging", lambda w: spark.range(n)), Step("b", "2-dimensions", lambda w: spark.range(n)),
                Step("look", "3-facts", last)]

    run_pipeline(spark, "/nonexistent", base, steps(2, lambda w: spark.range(1)))
    run_pipeline(spark, "/nonexistent", base, steps(5, look))
    assert seen == [{"a": 2, "b": 2, "look": 1}]
    assert store.read("b", store.latest().tables["b"]).count() == 5

    def boom(w):
        raise ValueError("no")

    run_pipeline(spark, "/nonexistent", base, steps(9, boom))
    assert store.latest().number == 2 and store.read("a", store.latest().tables["a"]).count() == 5


def test_an_overtaken_run_commits_nothing_and_says_so(spark):
    base = scratch_path(spark, "overtaken")

    def other_run(w):
        run_pipeline(spark, "/nonexistent", base, [Step("x", "1-staging", lambda w: spark.range(4))])
        return spark.range(1)

    run_pipeline(spark, "/nonexistent", base, [Step("y", "1-staging", other_run)])
    store = Store(spark, base)
    assert set(store.latest().tables) == {"x"}
    log = read_log(spark, base).filter("step = 'pipeline'").orderBy("log_id").collect()
    assert sorted(r["status"] for r in log) == sorted([C.FAILED, C.SUCCEEDED])
    assert "another run" in [r["message"] for r in log if r["status"] == C.FAILED][0]


SCHEMA = "id int, city string, seg string, geo long"


def test_stored_scd2_equals_whole_history_over_many_loads(spark):
    """Seven loads with changes, absent, new and unresolved rows: the stored
    dimension equals the recomputed one, and closed parts stay as written."""
    store, version, whole = Store(spark, scratch_path(spark, "loads")), None, None
    closed = {}
    for day in range(1, 8):
        inc = [(i, f"c{(i * day) % 3}", None if i % 5 == 0 else f"s{(i + day // 3) % 2}",
                None if (i + day) % 7 == 0 else i) for i in range(20 + day) if (i + day) % 4 or i < 3]
        inc = spark.createDataFrame(inc, SCHEMA)
        args = dict(sk="sk", key="id", tracked=["city", "seg"], attrs=["city", "seg"],
                    run_date=f"2024-02-0{day}", base_date="2024-01-01", require=["geo"])
        before = version
        whole = scd2_apply(whole, inc, **args)
        version, c = scd2_load(store, "d", version, inc, **args)
        assert rows(store.read("d", version)) == rows(whole)
        assert version.max_key == whole.agg(F.max("sk")).first()[0] == whole.count()
        assert c.kept + c.changed == (0 if before is None else store.read("d", before, ["current"]).count())
        for p in version.parts["closed"]:
            files = listing(spark, f"{store.path('d')}/{p}")
            assert closed.setdefault(p, files) == files
    assert len(version.parts["closed"]) >= 3 and len(version.parts["current"]) == 1
    again, c = scd2_load(store, "d", version, inc, **args)
    assert again is version and c.inserted() == 0  # nothing changed, nothing written


def test_two_runs_into_one_folder(spark):
    base, _ = stored_warehouse(spark, SMALL)
    store = Store(spark, base)
    state = store.latest()
    for table, query in (("dim_customer", "scd2_customer"), ("dim_product", "scd2_product")):
        assert rows(store.read(table, state.tables[table])) == rows(QUERIES[query](spark, SMALL))
        one, two = store.at(1).tables[table], state.tables[table]
        assert one.parts["closed"] == [] and len(two.parts["closed"]) == 1
    # a third run over the same sources adds nothing and rewrites no dimension
    before = {t: listing(spark, store.path(t)) for t in ("dim_customer", "dim_product")}
    run_pipeline(spark, SMALL, base, [s for s in _steps() if s.name in (
        "stg_customers", "stg_products", "dim_geography", "dim_store", "dim_customer", "dim_product")])
    for t, files in before.items():
        assert listing(spark, store.path(t)) == files and store.latest().tables[t] == state.tables[t]
    log = read_log(spark, base).orderBy(F.desc("log_id")).limit(6).collect()
    assert {r["rows_loaded"] for r in log if r["step"].startswith("dim_")} == {0}
    assert all(r["rows_read"] > 0 for r in log if r["step"] in ("dim_store", "dim_customer", "dim_product"))


def _steps():
    from tallyhouse.plans.pipeline import STEPS
    return STEPS


def test_a_step_runs_again_from_committed_inputs(spark):
    base, _ = stored_warehouse(spark, SMALL)
    store = Store(spark, base)
    want, before = rows(QUERIES["fact_purchases"](spark, SMALL)), store.latest()
    log = run_step(spark, "/no/such/source", base, "fact_purchases").collect()
    assert [(r["step"], r["status"]) for r in log] == [("fact_purchases", C.SUCCEEDED)]
    after = store.latest()
    assert after.number == before.number + 1
    assert {t for t in after.tables if after.tables[t] != before.tables[t]} == {"fact_purchases"}
    assert rows(store.read("fact_purchases", after.tables["fact_purchases"]).drop("month_key")) == want
    files = store.read("fact_sales", after.tables["fact_sales"]).inputFiles()
    assert files and all(os.path.basename(os.path.dirname(os.path.dirname(f))).startswith("all-") for f in files)


def test_files_added_to_the_input_are_read(spark, tmp_path):
    from tallyhouse.plans.warehouse import Warehouse
    folder = tmp_path / "input"
    (folder / "nation.parquet").mkdir(parents=True)
    spark.range(3).write.mode("append").parquet(str(folder / "nation.parquet"))
    one = Warehouse.shared(spark, str(folder))
    assert Warehouse.shared(spark, str(folder)) is one and one.src.t("nation").count() == 3
    spark.range(4).write.mode("append").parquet(str(folder / "nation.parquet"))
    two = Warehouse.shared(spark, str(folder))
    assert two is not one and two.src.t("nation").count() == 7


def test_a_checked_step_runs_its_plan_once_and_commits_nothing_if_the_check_fails(spark):
    base, made = scratch_path(spark, "checked"), spark.sparkContext.accumulator(0)

    def build(w):
        df = spark.range(10).repartition(2)

        def seen(batches):
            for b in batches:
                made.add(b.num_rows)
                yield b
        return df.mapInArrow(seen, "id long")

    def step(bad):
        return [Step("t", "3-facts", build, check=lambda w, df: df.where(F.col("id") > bad))]

    assert [r["status"] for r in run_pipeline(spark, "/nonexistent", base, step(9)).collect()] == [C.SUCCEEDED]
    assert made.value == 10
    assert [r["status"] for r in run_pipeline(spark, "/nonexistent", base, step(5)).collect()] == [C.FAILED]
    store = Store(spark, base)
    assert store.latest().number == 1 and len(commits(spark, f"{store.path('t')}/_commits")) == 1
