"""Bronze to silver to gold for one table or all of them, with audit rows."""

from __future__ import annotations

import json
import logging
import time
from datetime import datetime, timezone

from pyspark.sql import Observation, SparkSession, functions as F

from caudal import schemas
from caudal.operators import entities, generate
from caudal.sources import audit, folders, paths, rejects, tables

log = logging.getLogger(__name__)

PARTITIONS = {"transacciones": ["anio", "mes"]}
FILE = "_archivo"


def run_table(
    spark: SparkSession,
    entity: str,
    path: str,
    zones: paths.Zones,
    as_of,
    options: entities.Options = entities.Options(),
    partitioned: bool = False,
    multi_line: bool = False,
) -> dict:
    """Cleans and enriches one raw table. Gold is built from the silver files just written, so
    the csv is parsed once; row counts are observed while silver is written.

    Rows that can't be read stay out of silver; with their text, file and reason they are in a table beside it. Short rows are
    filled up with nulls and kept, as a lenient csv reader does, and are told of in the same table.
    """
    silver, gold, rejected = zones.silver_path(path), zones.gold_path(path), zones.rejected_path(path)
    raw = tables.read_bronze(spark, path, corrupt_column=True, multi_line=multi_line, file_column=FILE)
    seen = Observation()
    unreadable = rejects.is_unreadable(raw)
    counts = [F.count("*").alias("rows"), F.count(tables.CORRUPT).alias("bad_rows"), F.count_if(unreadable).alias("rejected")]
    cleaned = entities.clean(raw.observe(seen, *counts).where(~unreadable), entity, as_of, options)
    stamps = [c for c in entities.CLEANING[entity].timestamps if c in cleaned.columns]
    bad = F.coalesce(F.sum(F.greatest(*[F.col(c).isNull().cast("int") for c in stamps], F.lit(0))), F.lit(0)) \
        if stamps else F.lit(0)
    dates = Observation()
    tables.write_table(cleaned.observe(dates, bad.cast("bigint").alias("bad_dates")).drop(tables.CORRUPT, FILE), silver)
    found = seen.get | dates.get
    if found["bad_rows"]:
        # A second scan, only where the first has seen something; it needs no cleaning.
        tables.write_table(rejects.rejected_rows(raw, FILE), rejected)
    else:
        folders.delete(spark, rejected)
    enriched = entities.enrich(spark.read.parquet(silver), entity, as_of)
    tables.write_table(enriched, gold, PARTITIONS.get(entity) if partitioned else None)
    return {
        "processed_rows": found["rows"] - found["rejected"], "bad_rows": found["bad_rows"], "rejected_rows": found["rejected"],
        "bad_dates": found["bad_dates"], "source": path, "silver": silver, "gold": gold,
    }


class RunFailed(RuntimeError):
    """One or more tables could not be run; what they have in silver and gold is missing or old."""


def run_event(
    spark: SparkSession,
    event: dict,
    entity: str,
    zones: paths.Zones,
    as_of,
    audit_path: str | None = None,
    **options,
) -> dict:
    """Runs the table an event names and returns its summary; a failure has its audit row and is raised.

    A failure in the gold step leaves the new silver table in place.
    """
    started, clock = datetime.now(timezone.utc).replace(tzinfo=None), time.monotonic()
    record = {"entity": entity, "started": started}
    try:
        record["source"] = paths.event_path(event, zones)
        summary = run_table(spark, entity, record["source"], zones, as_of, **options)
    except Exception as problem:
        if audit_path:
            audit.append(spark, audit_path, **record, status="failed", error=str(problem), seconds=time.monotonic() - clock)
        raise RunFailed(f"run for {entity} failed: {problem}") from problem
    seconds = time.monotonic() - clock
    if audit_path:
        audit.append(spark, audit_path, **record | summary, status="ok", seconds=seconds)
    return {**summary, "execution_time": f"{seconds:.2f} segundos"}


def handle_event(
    spark: SparkSession,
    event: dict,
    entity: str,
    zones: paths.Zones,
    as_of,
    audit_path: str | None = None,
    **options,
) -> dict:
    """Runs the table an event names and answers ``{statusCode, body}``; failures answer 500. For callers that hand the answer
    on; a job that goes on with the table takes `run_event`, which raises."""
    try:
        return {"statusCode": 200, "body": json.dumps(run_event(spark, event, entity, zones, as_of, audit_path, **options))}
    except RunFailed as failed:
        log.exception("run for %s failed", entity)
        return {"statusCode": 500, "body": json.dumps({"error": f"Error procesando datos: {failed.__cause__}"})}


def run_all(spark: SparkSession, zones: paths.Zones, as_of, audit_path: str | None = None, **options) -> dict:
    """All five tables from ``<bronze>/<table>/<table>.csv``. All are run; if any failed, that is raised in the end."""
    answers = {
        e: handle_event(spark, {"input_path": f"{zones.bronze.rstrip('/')}/{e}/{e}.csv"}, e, zones,
                        as_of, audit_path, **options)
        for e in schemas.ENTITIES
    }
    failed = {e: json.loads(a["body"])["error"] for e, a in answers.items() if a["statusCode"] != 200}
    if failed:
        raise RunFailed("; ".join(f"{e}: {problem}" for e, problem in failed.items()))
    return answers


def run_failed(spark: SparkSession, zones: paths.Zones, as_of, audit_path: str, **options) -> dict:
    """Runs each table again whose last run failed and had an input. Tables that went well aren't touched."""
    last = audit.read(spark, audit_path).where("source is not null").groupBy("entity", "source").agg(
        F.max_by("status", "started").alias("status"))
    return {
        (r["entity"], r["source"]): handle_event(spark, {"input_path": r["source"]}, r["entity"], zones, as_of, audit_path, **options)
        for r in last.where("status = 'failed'").collect()
    }


def write_synthetic(
    spark: SparkSession,
    bronze: str,
    as_of,
    users: int = generate.USERS,
    recipients: int = generate.RECIPIENTS,
    seed: int = generate.SEED,
) -> None:
    """Makes the five raw csv tables, in any size."""
    made = generate.generate_all(spark.range(users), spark.range(recipients), as_of, seed)
    for entity, df in made.items():
        tables.write_bronze(df, f"{bronze.rstrip('/')}/{entity}/{entity}.csv")
