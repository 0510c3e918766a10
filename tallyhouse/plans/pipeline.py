"""The warehouse build as one logged run (PL1-PL3).

Five phases in dependency order - extract+validate, dimensions, facts,
derived facts, report - each step builds one table and writes it as a new
version (``sources.sinks.overwrite``: readers keep the old version until the
new one is committed).  Row counts come from ``DataFrame.observe`` on the
write itself (staging: rows read, valid = loaded, rejected; dimensions: new
members and closed versions), so logging costs no extra scan of the output; a
fact step also counts its valid staging input, and rejected = read - loaded is
the load reconciliation.  The run stops at the first failing step; the log names
it and its phase.  ``run_step`` rebuilds a single table from committed inputs.  Scheduling, retries and parallel step control are left to whatever
runs the job (the dependency order here is the data dependency).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhouse import constants as C
from tallyhouse.operators.rules import STATUS, valid
from tallyhouse.plans.stored import LOADS, Counts, Run
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.sources.sinks import Conflict, Version, append_log

LOG_SCHEMA = ("log_id int, step string, phase string, started_at timestamp, finished_at timestamp, "
              "status string, rows_written long, rows_read long, rows_loaded long, rows_rejected long, "
              "message string")


RUN, RUN_PHASE = "pipeline", "0-run"


class StepFailed(RuntimeError):
    pass


@dataclass(frozen=True)
class Step:
    name: str
    phase: str
    build: Callable[[Warehouse], DataFrame] | None = None
    # optional test before anything is built; raises StepFailed
    guard: Callable[[Warehouse], None] | None = None
    # optional pre-commit check of the rows as written: a DataFrame of violating
    # rows (must be empty), so the plan that made them runs once
    check: Callable[[Warehouse, DataFrame], DataFrame] | None = None
    # facts are written partitioned by month of date_key (partition pruning
    # for date-range reads, files grouped by month)
    by_month: bool = False
    # input whose row count is "rows read" (facts: their valid staging rows);
    # rejected = read - loaded, the load reconciliation
    reads: Callable[[Warehouse], DataFrame] | None = None
    # dimensions: adds to the stored version instead of writing a new table
    load: Callable[[Run], Counts] | None = None


def _date_fk(w: Warehouse, df: DataFrame) -> DataFrame:
    """Fact rows whose date key is missing from the calendar."""
    return df.select("date_key").join(w.dim_date.select("date_key"), "date_key", "left_anti")


def _nonempty_refs(w: Warehouse) -> None:
    """An empty reference table would make NOT IN rules pass everything."""
    s = w.src
    empty = [name for name, ref in [("customers", s.customers()), ("products", s.products()),
                                    ("suppliers", s.suppliers()), ("stores", s.stores())]
             if ref.limit(1).count() == 0]
    if empty:
        raise StepFailed(f"empty reference table(s): {', '.join(empty)}")


STAGING = ["stg_sales", "stg_products", "stg_customers", "stg_inventory", "stg_returns", "stg_purchases",
           "stg_goals", "stg_adjustments"]
DIMENSIONS = ["dim_date", "dim_geography", "dim_promotion", "dim_channel", "dim_supplier", "dim_store",
              "dim_salesperson", "dim_customer", "dim_product"]


def _plan(name: str) -> Callable[[Run], DataFrame]:
    return lambda r: r.plan(name)


STEPS: list[Step] = [
    *[Step(n, "1-staging", _plan(n), guard=_nonempty_refs if n == "stg_sales" else None) for n in STAGING],
    *[Step(n, "2-dimensions", load=LOADS[n]) for n in DIMENSIONS],
    Step("fact_sales", "3-facts", _plan("fact_sales"), None, _date_fk, True, lambda w: valid(w.stg_sales)),
    Step("fact_inventory", "3-facts", _plan("fact_inventory"), None, _date_fk, True,
         lambda w: valid(w.stg_inventory).select(F.lit(1).alias("x"))
         .unionByName(valid(w.stg_adjustments).select(F.lit(1).alias("x")))),
    Step("fact_goals", "3-facts", _plan("fact_goals"), None, _date_fk, True, lambda w: valid(w.stg_goals)),
    Step("fact_returns", "3-facts", _plan("fact_returns"), None, _date_fk, True, lambda w: valid(w.stg_returns)),
    Step("fact_purchases", "3-facts", _plan("fact_purchases"), None, _date_fk, True, lambda w: valid(w.stg_purchases)),
    Step("fact_profitability", "4-derived", _plan("fact_profitability"), None, _date_fk, True, lambda w: w.fact_sales),
    Step("quality_summary", "5-report", lambda w: _report(w)),
]


def _report(w: Warehouse) -> DataFrame:
    from tallyhouse.plans.quality import quality_summary
    return quality_summary({n: getattr(w, n) for n in STAGING})


def _write_step(run: Run, w, step: Step) -> Counts:
    """Run one step: a dimension is loaded into its stored version, any other
    table is written as a new one."""
    if step.load is not None:
        return step.load(run)
    if step.guard is not None:
        step.guard(w)
    df = step.build(w)
    obs = Observation(f"obs_{step.name}")
    metrics = [F.count(F.lit(1)).alias("rows")]
    staged = STATUS in df.columns
    if staged:   # staging: the rule outcome is counted in the same pass as the write
        metrics += [F.count_if(F.col(STATUS) == C.VALID).alias("valid"),
                    F.count_if(F.col(STATUS) == C.REJECTED).alias("rejected")]
    df = df.observe(obs, *metrics)
    if step.by_month:
        df = df.withColumn("month_key", (F.col("date_key") / 100).cast("int"))
        # one shuffle so each month's rows land in few files; AQE splits the
        # partitions of a hot month by their measured size
        df = df.hint("rebalance", "month_key")
    part = run.store.write(df, step.name, partition_by=["month_key"] if step.by_month else None)
    version = Version({"all": [part]})
    if step.check is not None and not step.check(w, run.store.read(step.name, version)).isEmpty():
        raise StepFailed(f"{step.name}: pre-commit check failed; previous version kept")
    run.wrote(step.name, version)
    m = obs.get
    rows = int(m["rows"])
    if staged:
        return Counts(rows, rows, int(m["valid"]), int(m["rejected"]))
    if step.reads is not None:
        read = step.reads(w).count()
        return Counts(rows, read, rows, read - rows)
    return Counts(rows, rows, rows)


def run_pipeline(spark: SparkSession, sf_dir: str, out_base: str, steps: list[Step] | None = None,
                 warehouse=None, **options) -> DataFrame:
    """Run all steps in order; returns the log of this run's steps.

    Steps read what this run has written and else the last committed state;
    a run that succeeds commits all it has written as the next one, so its
    readers (``sinks.Store``) never see half a run.  A run that fails, or that
    another one overtook, commits nothing.  ``options``: the state of the
    sources and the dates of the load (``stored.Run``).

    ``{out_base}/_log`` gets a row when the run and each step begins
    (``RUNNING``) and another, with the same log id, when it ends, so a run
    whose driver dies leaves the step it was in.  ``read_log`` gives one row
    per log id."""
    run = Run(spark, sf_dir, out_base, **options)
    first = last_log_id(spark, out_base) + 1

    def note(i: int, name: str, phase: str, t0: dt.datetime, end: dt.datetime | None, status: str,
             counts: Counts | None = None, message: str | None = None) -> tuple:
        numbers = (counts.written, counts.read, counts.loaded, counts.rejected) if counts else (None,) * 4
        row = (i, name, phase, t0, end, status, *numbers, message)
        append_log(spark.createDataFrame([row], LOG_SCHEMA), f"{out_base}/_log")
        return row

    began, log, failed = dt.datetime.now(), [], None
    note(first, RUN, RUN_PHASE, began, None, C.RUNNING)
    for i, step in enumerate(steps or STEPS, start=first + 1):
        t0 = dt.datetime.now()
        note(i, step.name, step.phase, t0, None, C.RUNNING)
        try:
            counts = _write_step(run, warehouse or run, step)
            log.append(note(i, step.name, step.phase, t0, dt.datetime.now(), C.SUCCEEDED, counts))
        except Exception as exc:  # stop at the first failure, name the phase
            failed = f"phase {step.phase}, step {step.name}: {str(exc).splitlines()[0][:500]}"
            log.append(note(i, step.name, step.phase, t0, dt.datetime.now(), C.FAILED, message=failed))
            break
    if not failed:
        try:
            run.commit()
        except Conflict as exc:
            failed = str(exc)
    note(first, RUN, RUN_PHASE, began, dt.datetime.now(), C.FAILED if failed else C.SUCCEEDED, message=failed)
    return spark.createDataFrame(log, LOG_SCHEMA)


def read_log(spark: SparkSession, out_base: str) -> DataFrame:
    """One row per log id: the closing row, or the opening one of what has not ended."""
    log = spark.read.schema(LOG_SCHEMA).parquet(f"{out_base}/_log")
    rest = [c for c in log.columns if c != "log_id"]
    last = F.max_by(F.struct(*rest), F.col("finished_at").isNotNull().cast("int")).alias("last")
    return log.groupBy("log_id").agg(last).select("log_id", *[F.col(f"last.{c}").alias(c) for c in rest])


def last_log_id(spark: SparkSession, out_base: str) -> int:
    """The highest log id of the runs so far, 0 before the first."""
    try:
        log = spark.read.schema(LOG_SCHEMA).parquet(f"{out_base}/_log")
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise
    return log.agg(F.max("log_id")).first()[0] or 0


def run_step(spark: SparkSession, sf_dir: str, out_base: str, name: str, **options) -> DataFrame:
    """Run a single step again.  It reads its inputs as last committed; of the
    source only what the step itself extracts."""
    step = next(s for s in STEPS if s.name == name)
    return run_pipeline(spark, sf_dir, out_base, steps=[step], **options)


def latest_first(log: DataFrame) -> DataFrame:
    """The log as read by an operator: latest rows first."""
    return log.orderBy(F.desc("log_id"))


def elapsed(log: DataFrame) -> DataFrame:
    """Per step duration in seconds (the run duration the log reports)."""
    return log.select("log_id", "step", (F.col("finished_at").cast("double")
                                         - F.col("started_at").cast("double")).alias("seconds"))


__all__ = ["Step", "STEPS", "run_pipeline", "run_step", "read_log", "latest_first", "elapsed", "StepFailed"]
