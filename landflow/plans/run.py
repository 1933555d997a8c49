"""A configured run: admit, read, check, curate and publish one entity, with an audit record for each step."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from landflow.config import EntityConfig, output_name
from landflow.operators import admission
from landflow.operators import audit as A
from landflow.operators import rules as R
from landflow.operators.history import HistorySpec
from landflow.operators.snapshot import snapshot_rows
from landflow.plans import entity_load, publish
from landflow.session import scratch_path
from landflow.sources import readers, sinks

ADMIT, CHECK, CURATE, PUBLISH = A.VALIDATION_STEP, "LandingToRaw", "RawToCurated", "CuratedToPublished"
FAILED, SUCCEEDED, AWAITING = "Failed", "Succeeded", "Await"
#: Error of a run whose files were all refused.
NOTHING_ADMITTED, ALL_REJECTED = "no file was admitted", "every file has rejected records"


class NothingLeft(ValueError):
    """A step has refused everything that it was given."""


def history_spec(config: EntityConfig) -> HistorySpec:
    """The history that an ``scd2`` configuration describes."""
    return HistorySpec(
        keys=config.keys,
        change_column=config.hash_column_name,
        date_keys=tuple(config.date_key_columns),
        order_column=config.watermark_column,
    )


def publish_by_load_type(
    staged: DataFrame, path: str, config: EntityConfig, run_ts: dt.datetime, batch: str, parts: int = 64
) -> dict[str, int]:
    """Publish as ``load_type`` says; the counts that the audit wants.  Unchanged rows count as landed, not as rejected."""
    kind = config.load_type.lower()
    if kind == "snapshot":
        done = publish.publish_snapshot(snapshot_rows(staged, run_ts.date()), path, batch, run_ts)
    elif kind == "full":
        done = publish.publish_full(staged, path, batch, run_ts)
    else:
        done = publish.publish_history(staged, path, history_spec(config), run_ts, batch, parts=parts)
    counts = {
        "previouscount": done.previous,
        "insertedcount": done.inserted,
        "updatedcount": done.updated,
        "totalcount": done.inserted + done.updated + done.unchanged,
    }
    return counts | ({"rejectcount": done.stale + done.conflicts} if kind == "scd2" else {})


# ------------------------------------------------------------------ admission


def admit(
    spark: SparkSession, landing: str, config: EntityConfig, run_ts: dt.datetime, name: str, listing: DataFrame | None = None,
    manifest: DataFrame | None = None,
) -> DataFrame:
    """The verdict on every landed data file, by the rules of the configuration.

    ``listing`` and ``manifest``, if given, take the place of those of the landing folder; headers are read
    only where the folder is listed.
    """
    found = readers.list_landing(spark, landing) if listing is None else listing
    data, _ = admission.split_listing(found, config.manifest_prefix)
    headers = readers.header_columns(spark, landing, config.delimiter, config.encoding) if listing is None else None
    declared = readers.read_manifest(spark, landing, config.manifest_prefix) if manifest is None else manifest
    return admission.admission_verdict(
        data, declared, run_ts, {name: config.input_file_extension},
        prefixes=config.allowed_prefixes, aliases=[name], name_pattern=config.file_pattern, header_columns=headers,
        max_sla_hours=config.max_sla_hours, manifest_prefix=config.manifest_prefix,
    )


def _file_records(files: DataFrame, error: str, record: Mapping[str, object]) -> DataFrame:
    """One audit record for each file: ``file_name, executionstatus`` and an error."""
    given = {k: F.lit(v) for k, v in record.items()}
    return A.as_audit(files, given | {"sourcename": F.col("file_name"), "errormessage": F.col(error)})


# ------------------------------------------------------------------ the run


def run_entity(
    spark: SparkSession,
    landing: str,
    config: EntityConfig,
    root: str,
    run_ts: dt.datetime,
    batch: str,
    name: str = "entity",
    region: str = "",
    parts: int = 64,
    lines: DataFrame | None = None,
    listing: DataFrame | None = None,
    manifest: DataFrame | None = None,
) -> str:
    """Run all steps on the files at ``landing``; returns the last status.

    Tables go below ``root`` by their configured names, checked rows and rejects below ``checked`` and
    ``rejects``, audit records to ``audit``.  A step that fails is recorded with its error, and the steps
    after it are not tried.  A configuration without any check fails the first step.

    With ``admission`` only files that pass the admission rules are read, and each file's verdict is
    recorded.  With ``reject_files`` a file with any rejected row is withheld whole and recorded as failed.
    ``lines`` (numbered, see :func:`readers.number_lines`) takes the place of reading the files, for callers
    that have them already, ``listing`` that of listing them, and ``manifest`` that of reading the manifests.
    """
    curated = f"{root}/{config.curated_table or f'curated_{name}'}"
    published = f"{root}/{config.published_table or f'published_{name}'}"
    state: dict[str, DataFrame | None] = {"admitted": None}
    common = {
        "batchid": batch, "batchrundate": run_ts.date(), "regionname": region, "filename": landing,
        "executionstarttime": run_ts, "executionendtime": run_ts, "data_refresh_mode": config.load_type,
    }

    def admit_files() -> Mapping[str, int]:
        verdict = sinks.stage_overwrite(admit(spark, landing, config, run_ts, name, listing, manifest), f"{root}/admission/{name}/batch={batch}")
        status = F.when(F.col("status") == admission.ACCEPT, SUCCEEDED).when(F.col("status") == admission.AWAIT, AWAITING).otherwise(FAILED)
        records = _file_records(verdict.withColumn("executionstatus", status), "reason", common | {"processname": ADMIT})
        sinks.append_audit(records, f"{root}/audit")
        counts = verdict.agg(F.count(F.lit(1)), F.count_if(F.col("status") == admission.ACCEPT)).first()
        if not counts[1]:
            raise NothingLeft(NOTHING_ADMITTED)
        state["admitted"] = verdict.where(F.col("status") == admission.ACCEPT).select("path")
        return {"landingcount": counts[0], "rawcount": counts[1], "rejectcount": counts[0] - counts[1]}

    def raw_rows() -> DataFrame:
        if lines is None:
            return readers.read_entity(spark, landing, config, state["admitted"])
        wanted = lines if state["admitted"] is None else readers.join_files(lines, state["admitted"], "left_semi")
        return readers.rows_of_lines(wanted, config)

    def check() -> Mapping[str, int]:
        config.require_checks()
        found = entity_load.check_entity(raw_rows(), config, region)
        rows = found.checked
        if config.dq_checks and config.dq_checks.business_key_unique_check and config.keys:
            once = scratch_path(spark, "checked")
            rows.write.parquet(once)  # looked at twice: the raw data is read once
            rows = R.key_unique_rule(spark.read.schema(rows.schema).parquet(once), config.keys)
        seen, failing = Observation("checked"), F.size(R.REJECTS) > 0
        copies = F.col(entity_load.LANDED) if entity_load.LANDED in rows.columns else F.lit(1)
        rows = rows.observe(seen, F.coalesce(F.sum(copies), F.lit(0)).alias("landed"), F.count_if(~failing).alias("passed"))
        checked = sinks.stage_overwrite(rows.drop(entity_load.LANDED), f"{root}/checked/{name}")
        R.failed(checked).write.mode("overwrite").parquet(f"{root}/rejects/{name}/batch={batch}")
        landed, kept = seen.get["landed"], seen.get["passed"]
        passed = R.passed(checked)
        if config.reject_files:
            per_file = R.file_verdict(R.step_counts(checked, [readers.SOURCE_PATH]))
            verdicts = per_file.withColumn("file_name", admission.file_name(F.col(readers.SOURCE_PATH)))
            sinks.append_audit(_file_records(verdicts, "errormessage", common | {"processname": CHECK}), f"{root}/audit")
            sums = per_file.where(F.col("executionstatus") == SUCCEEDED).agg(F.sum("raw_count")).first()
            kept = sums[0] or 0
            if landed and not kept:
                raise NothingLeft(ALL_REJECTED)
            passed = R.withhold_failed_files(checked, per_file, readers.SOURCE_PATH).select(*passed.columns)
        state["clean"] = found.typed(passed)
        return {"landingcount": landed, "rawcount": kept, "rejectcount": landed - kept}

    def curate() -> Mapping[str, int]:
        ready = entity_load.prepare_for_publish(state["clean"], config, run_ts, name, one_per_key=config.load_type.lower() != "scd2")
        refused = None
        if config.dq_checks and config.dq_checks.replay_check and config.watermark_column and publish.manifests(spark, published):
            before = publish.read_published(spark, published)
            again, tested = Observation("replayed"), scratch_path(spark, "tested")
            rows = R.replay_rule(ready, before, config.keys, config.watermark_column, config.hash_column_name)
            rows.observe(again, F.count_if(F.size(R.REJECTS) > 0).alias("n")).write.parquet(tested)
            tested = spark.read.schema(rows.schema).parquet(tested)
            R.failed(tested).write.mode("overwrite").parquet(f"{root}/rejects/{name}_replayed/batch={batch}")
            ready, refused = R.passed(tested), again.get["n"]
        written = Observation("curated")
        state["staged"] = sinks.stage_overwrite(ready.observe(written, F.count(F.lit(1)).alias("n")), curated)
        return {"totalcount": written.get["n"], "rejectcount": refused}

    def publish_step() -> Mapping[str, int]:
        return publish_by_load_type(state["staged"], published, config, run_ts, batch, parts)

    steps: list[tuple[str, Callable[[], Mapping[str, int]]]] = [(CHECK, check), (CURATE, curate), (PUBLISH, publish_step)]
    if config.admission:
        steps.insert(0, (ADMIT, admit_files))
    for process, step in steps:
        record = common | {"processname": process, "sourcename": name}
        try:
            counts = step()
        except Exception as error:  # recorded, and the run stops here
            failed = A.audit_record(spark, record | {"executionstatus": FAILED, "errormessage": str(error)})
            sinks.append_audit(failed, f"{root}/audit")
            return FAILED
        sinks.append_audit(A.audit_record(spark, record | {"executionstatus": SUCCEEDED} | dict(counts)), f"{root}/audit")
    return SUCCEEDED


def run_tables(
    spark: SparkSession, landing: str, tables: Mapping[str, EntityConfig], file_key: str, root: str, run_ts: dt.datetime, batch: str
) -> dict[str, str]:
    """Every logical table of a file by its own configuration; one that fails does not stop the others.

    The text is read once: its numbered lines are stored, and each table takes its rows from there.
    """
    lines = readers.numbered_lines(spark, landing)
    return {
        table: run_entity(spark, landing, config, root, run_ts, batch, output_name(file_key, table, len(tables)), lines=lines)
        for table, config in tables.items()
    }


def audit_of(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(A.AUDIT_SCHEMA).parquet(f"{root}/audit").orderBy(F.col("executionstarttime"), "processname")
