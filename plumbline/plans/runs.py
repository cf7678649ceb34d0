"""End-to-end runs built from the operators: one table, many tables, change capture, audits."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from datetime import datetime, timezone
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.contracts import Contract
from plumbline.operators import incremental, parity, pii, reconcile
from plumbline.operators.transform import mask_personal, normalise, with_extract_audit, with_load_audit
from plumbline.sinks.files import write_batch, write_extract, write_rows
from plumbline.sinks.ledger import Ledger
from plumbline.sinks.versioned import VersionedTable
from plumbline.streaming import cdc
from plumbline.sources.files import batch as read_batch

MAX_CONCURRENT_TABLES = 4
POLL_SECONDS = 1
LOAD_AUDIT = "_source_system string, _extracted_at timestamp, _loaded_at timestamp, _is_current boolean, _batch_id string"


@dataclass(frozen=True)
class Run:
    """Where a run reads and writes."""

    spark: SparkSession
    root: str
    job: str = "move"
    buckets: int = 16

    @property
    def ledger(self) -> Ledger:
        return Ledger(self.spark, f"{self.root}/ledger")

    def raw(self, contract: Contract, batch_id: str) -> str:
        return f"{self.root}/raw/{contract.table}/{batch_id}"

    def staged(self, contract: Contract, batch_id: str) -> str:
        return f"{self.root}/staging/{contract.table}/{batch_id}"

    def report(self, contract: Contract, batch_id: str) -> str:
        return f"{self.root}/reports/{contract.table}/{batch_id}"

    def target(self, contract: Contract, side: str) -> VersionedTable:
        audit = T.StructType.fromDDL(LOAD_AUDIT)
        schema = T.StructType([*contract.target_schema().fields, *audit.fields])
        name = getattr(contract, side)
        # What is loaded is read from the staging zone.
        return VersionedTable(self.spark, f"{self.root}/{side}/{name}", schema, list(contract.keys), self.buckets, from_files=True)


@dataclass(frozen=True)
class Outcome:
    table: str
    batch_id: str
    status: str
    rows: int = 0
    detail: str = ""


def _gate(spark: SparkSession, reports: dict[str, list[dict]], path: str) -> None:
    """Keep the reports of one step, of five rows each, and stop the run if any layer failed."""
    rows = [{**r, "phase": phase} for phase, report in reports.items() for r in report]
    write_rows(spark, rows, path)
    failed = sorted(f"{r['phase']} {r['layer']}" for r in rows if r["status"] == reconcile.FAILED)
    if failed:
        raise RuntimeError(f"reconciliation failed: {', '.join(failed)}")


def _no_lost_values(spark: SparkSession, lost: dict[str, tuple[int, int]], contract: Contract, path: str) -> None:
    """Stop the run if values that were there could not be read as declared; the columns concerned are reported.

    Both sides of the later checks are typed by the same code, so only the raw rows show such a loss. Where the
    contract declares a default for what it does not know, the loss is a warning.
    """
    lost = {c: counts for c, counts in sorted(lost.items()) if counts[1] > contract.lost_values}
    if not lost:
        return
    defaulted = {f.target for f in contract.data_fields if f.default_sql is not None}
    write_rows(spark, [{
        "phase": "coercion", "layer": reconcile.LAYERS[1], "status": reconcile.WARNING if c in defaulted else reconcile.FAILED,
        "message": f"{n} unreadable value(s) in {c}",
        "evidence": json.dumps({"column_name": c, "present_count": present, "lost_count": n}),
    } for c, (present, n) in lost.items()], path)
    if stopping := [c for c in lost if c not in defaulted]:
        raise RuntimeError(f"unreadable values: {', '.join(stopping)}")


def _load_and_check(run: Run, contract: Contract, batch_id: str, typed: DataFrame, staged: dict[str, dict], at: datetime) -> None:
    """Load both targets and compare them with what was staged; on any failure put both back.

    staged: the measures of the staged rows, plain and as masked. Of a target only the buckets are read that the load rewrote: all
    rows of the batch are there.
    """
    operational = run.target(contract, "operational")
    analytical = run.target(contract, "analytical")
    before = {table: table.version() for table in (operational, analytical)}
    loaded = with_load_audit(typed, contract, batch_id, at)
    # A batch that failed may run again with other rows, so every attempt has its own commit name.
    attempt = f"{batch_id}#{uuid.uuid4().hex[:8]}"
    try:
        # The two loads are independent jobs on different tables.
        with ThreadPoolExecutor(2) as pool:
            loads = [
                pool.submit(operational.upsert, loaded, attempt),
                pool.submit(analytical.delete_insert, mask_personal(loaded, contract), attempt),
            ]
        mine = F.col("_batch_id") == batch_id
        rows = {
            "operational": operational.written(loads[0].result()).filter(mine),
            "analytical": analytical.written(loads[1].result()).filter(mine),
        }
        found = reconcile.measured({side: (df, True) for side, df in rows.items()}, contract)
        expected = {"operational": typed, "analytical": mask_personal(typed, contract)}
        pairs = {
            f"post_load_{side}": (staged[side], found[side], lambda side=side: reconcile.bands_of(expected[side], rows[side], contract))
            for side in rows
        }
        _gate(run.spark, reconcile.reports_of(run.spark, pairs, contract, batch_id), f"{run.report(contract, batch_id)}/load")
    except Exception:
        for table, version in before.items():
            if table.version() != version:
                table.restore(version, f"undo-{attempt}")
        raise


def run_table(
    run: Run, contract: Contract, batch_id: str, source: Callable[[str | None], DataFrame], at: datetime | None = None,
) -> Outcome:
    """Extract, check, transform, load both targets, check again.

    The source is read once: what the checks need of it is measured while the extract is written.
    ``source`` gives the source rows newer than a watermark. Nothing is loaded if the first check
    fails; if the second fails, the targets are put back. The watermark moves on success only.
    """
    at = at or datetime.now(timezone.utc)
    ledger = run.ledger
    if problems := contract.problems():
        return Outcome(contract.table, batch_id, "FAILED", detail="; ".join(problems))
    # The ledger has a clock of its own; ``at`` is the time the rows are labelled with.
    if not ledger.start(run.job, batch_id):
        return Outcome(contract.table, batch_id, "SKIPPED")
    try:
        mark = ledger.watermark(run.job, contract.fqn) if contract.strategy == "incremental_merge" else None
        written = write_extract(
            with_extract_audit(source(mark), contract, at), contract, run.raw(contract, batch_id), at
        )
        raw = read_batch(run.spark, written.path)
        _no_lost_values(run.spark, written.lost, contract, f"{run.report(contract, batch_id)}/coercion")
        # The checks compare in target form: raw text and typed rows never match byte for byte.
        path = write_batch(normalise(raw, contract), run.staged(contract, batch_id)).path
        typed = read_batch(run.spark, path)
        sides = {"operational": (typed, True)}
        if contract.mask_personal:
            sides["analytical"] = (mask_personal(typed, contract), False)
        staged = reconcile.measured(sides, contract)
        # The source was measured while it was read; the raw batch is what it gave.
        pairs = {"post_extract": (
            written.totals, staged["operational"], lambda: reconcile.bands_of(normalise(raw, contract), typed, contract))}
        _gate(run.spark, reconcile.reports_of(run.spark, pairs, contract, batch_id), f"{run.report(contract, batch_id)}/extract")
        _load_and_check(run, contract, batch_id, typed, {"analytical": staged["operational"], **staged}, at)
        ledger.succeed(run.job, batch_id, written.rows, table=contract.fqn, watermark=written.watermark)
        return Outcome(contract.table, batch_id, "SUCCEEDED", written.rows)
    except Exception as error:
        ledger.fail(run.job, batch_id, str(error))
        return Outcome(contract.table, batch_id, "FAILED", detail=str(error))


def roll_back(run: Run, contract: Contract, batch_id: str) -> str | None:
    """Take one load back: its rows leave both targets, rows that they had replaced return, the ledger says so, and the watermark returns to where it was.

    The batch may then run again. Gives the watermark.
    """
    attempt = uuid.uuid4().hex[:8]
    for side in ("operational", "analytical"):
        run.target(contract, side).undo_batch(batch_id, f"rollback-{batch_id}#{attempt}")
    return run.ledger.rolled_back(run.job, batch_id, contract.fqn)


def run_many(
    run: Run, work: list[tuple[Contract, str, Callable[[str | None], DataFrame]]], needs: dict[str, list[str]] | None = None,
    concurrency: int = MAX_CONCURRENT_TABLES,
) -> list[Outcome]:
    """Several tables, a few at a time; Spark shares the executors among their jobs.

    needs: table -> tables that must be loaded before it. A table starts as soon as all of its are, and is held back, with all that
    need it, if one of them fails. Under a fair scheduler every table has a pool of its own.
    """
    needs = needs or {}
    by_table = {w[0].table: w for w in work}
    if unknown := {n for t in by_table for n in needs.get(t, ())} - set(by_table):
        raise ValueError(f"needed, but not among the work: {sorted(unknown)}")

    def one(table: str) -> Outcome:
        run.spark.sparkContext.setLocalProperty("spark.scheduler.pool", table)
        return run_table(run, *by_table[table])

    def is_loaded(outcome: Outcome) -> bool:
        # What is skipped may be done, or only under way.
        return outcome.status == "SUCCEEDED" or outcome.status == "SKIPPED" and run.ledger.is_processed(run.job, outcome.batch_id)

    order = TopologicalSorter({t: needs.get(t, ()) for t in by_table})
    order.prepare()
    outcomes: dict[str, Outcome] = {}
    with ThreadPoolExecutor(concurrency) as pool:
        running = {}
        while order.is_active():
            for table in order.get_ready():
                if waiting := [n for n in needs.get(table, ()) if not is_loaded(outcomes[n])]:
                    outcomes[table] = Outcome(table, by_table[table][1], "HELD", detail=f"not loaded: {', '.join(waiting)}")
                    order.done(table)
                else:
                    running[pool.submit(one, table)] = table
            for done in wait(running, return_when=FIRST_COMPLETED).done:
                table = running.pop(done)
                outcomes[table] = done.result()
                order.done(table)
    return [outcomes[w[0].table] for w in work]


def run_cdc(
    spark: SparkSession, contract: Contract, feed_dir: str, root: str, schema, buckets: int = 16,
    max_files: int | None = None,
) -> VersionedTable:
    """Take in all new change files and merge them into silver.

    Both steps run at once: silver merges what bronze has committed while bronze takes in the next files, so the slower of the
    two sets the time. max_files: how many files a micro-batch of either step takes at most.
    """
    bronze, checkpoints = f"{root}/bronze", f"{root}/checkpoints"
    silver = VersionedTable(spark, f"{root}/silver", cdc.silver_schema(contract), list(contract.keys), buckets)

    def merge() -> None:
        cdc.merge_silver(spark, bronze, silver, checkpoints, contract, cdc.bronze_schema(schema), max_files).awaitTermination()

    ingest, merged = cdc.ingest_bronze(spark, feed_dir, bronze, checkpoints, schema, max_files), None
    try:
        while not ingest.awaitTermination(POLL_SECONDS):
            committed = cdc.last_commit(ingest)
            if committed != merged:
                merge()
                merged = committed
    finally:
        if ingest.isActive:
            ingest.stop()
    merge()
    return silver


def run_post_load(raw: DataFrame, operational: DataFrame, analytical: DataFrame, contract: Contract) -> DataFrame:
    """Status per comparison of the three-way check."""
    return parity.comparison_statuses(parity.three_way(raw, operational, analytical, contract))


def run_incremental(source: DataFrame, target: DataFrame, contract: Contract, after, up_to) -> DataFrame:
    """Window layers of one increment."""
    return incremental.window_report(source, target, contract, after, up_to)


def run_pii_audit(tables: list[tuple[Contract, DataFrame]]) -> DataFrame:
    """Audit rows of every table whose contract asks for masking."""
    rows = None
    for contract, df in tables:
        if not contract.mask_personal:
            continue
        part = pii.audit_columns(df, contract.analytical, contract.personal_columns)
        rows = part if rows is None else rows.unionByName(part)
    return rows
