"""Publishing to Parquet tables.

Layout of a history table::

    <path>/batches/<batch>-<unique>/kind=current|closed|.../part=<part>/   what one batch wrote
    <path>/manifest/<version>-change|full|base-<unique>/                   where the rows are

``part`` is computed from the key, so a batch reads and rewrites only the parts it touches.  A batch
writes to a new folder that nobody reads; then the next manifest names what it replaces or adds.  A
manifest counts once Spark has marked its folder as complete: before that the table is the old one,
afterwards it is the new one, and whatever a batch that died has left has another name.

Most manifests hold the changes of one batch.  Every ``FULL_EVERY``-th names the current folder of each
part, so the next batch reads that one and the changes since, whatever the table's age.  Folders of closed
versions are named once, by the batch that closed them; a ``base`` manifest, which a roll back or a
vacuum writes, names all of them and starts that list anew.  One writer at a time is assumed; two
manifests of one version are an error, unless the second is the ``base`` of a vacuum.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landflow.functions.literals import moment
from landflow.operators.duplicates import fingerprint
from landflow.operators.history import HistorySpec, first_load, versions_alone, versions_of_batch
from landflow.operators.joins import BITMAP, bit_filter, by_bit, key_columns, with_keys
from landflow.operators.projection import cols, quoted
from landflow.session import scratch_path
from landflow.sources import commits
from landflow.sources.sinks import CODEC

PART = "part"
#: Stands for a part that is null, such as the month of a missing key date.
NO_PART = -1
#: ``folder`` is null where a part has no rows any more; ``at`` is when the table came to this version.
MANIFEST = "version long, at timestamp, kind string, part int, folder string, rows long"
#: Batches from one manifest that names all current folders to the next.
FULL_EVERY = 16
CHANGE, FULL, BASE = "change", "full", "base"
#: Pieces that all parts are cut into for the shuffle of whole rows, and at most as many files of a kind.
PIECES = 2048
#: Changed keys that Spark broadcasts; where more change, the rows of their parts are shuffled without telling them apart first.
FEW_KEYS = 500_000
#: Larger batches write rows that meet no other of their key without a shuffle, if the table has few parts: a task then
#: writes a file for each part, of at most so many rows in all.
FEW_PARTS, TASK_ROWS = 16, 400_000
#: Bits that tell the keys which meet others, for each row that is compared, and at most (32 MB, broadcast).
BITS_A_ROW, MOST_BITS = 4, 1 << 28


@dataclass(frozen=True)
class Published:
    """What a batch did: rows by what became of them, and the table's schema."""

    schema: T.StructType
    inserted: int
    updated: int
    versions: int
    unchanged: int
    stale: int
    conflicts: int
    #: folder of the batch, None if nothing was written
    rejects: str | None
    previous: int = 0


def hash_part(spec: HistorySpec, parts: int) -> Column:
    """Default part of a key: a hash of its normalised text."""
    return F.pmod(F.xxhash64(*key_columns(spec.keys, spec.date_keys).values()), F.lit(parts)).cast("int")


# ------------------------------------------------------------------ manifests


@dataclass(frozen=True)
class Manifest:
    """A complete manifest, as its folder's name tells."""

    version: int
    form: str
    name: str


def manifests(spark: SparkSession, path: str) -> list[Manifest]:
    """All complete manifests, oldest first."""
    found: dict[int, Manifest] = {}
    for name in commits.committed(spark, f"{path}/manifest"):
        version, form, _ = name.split("-", 2)
        new, old = Manifest(int(version), form, name), found.get(int(version))
        if old and (old.form == BASE) == (form == BASE):
            raise ValueError(f"two writers have published the same version of {path}")
        found[new.version] = old if old and old.form == BASE else new
    return [found[version] for version in sorted(found)]


def _upto(spark: SparkSession, path: str, version: int | None) -> list[Manifest]:
    found = manifests(spark, path)
    if version is None:
        return found
    if version not in {m.version for m in found}:
        raise ValueError(f"{path} has no version {version}")
    return [m for m in found if m.version <= version]


def _since(found: Sequence[Manifest], *forms: str) -> list[Manifest]:
    """The manifests from the newest of these forms on."""
    start = max((k for k, m in enumerate(found) if m.form in forms), default=0)
    return list(found[start:])


def _entries(spark: SparkSession, path: str, chosen: Sequence[Manifest], kind: str) -> DataFrame:
    if not chosen:
        return spark.createDataFrame([], MANIFEST)
    rows = spark.read.schema(MANIFEST).json([f"{path}/manifest/{m.name}" for m in chosen])
    return rows.where(F.col("kind") == kind)


def _current(spark: SparkSession, path: str, found: Sequence[Manifest], parts: DataFrame | None = None) -> dict[int | None, tuple[str, int]]:
    """Folder and rows of each part (of those in ``parts``): the newest that the manifests name."""
    entries = _entries(spark, path, _since(found, FULL, BASE), "current")
    if parts is not None:
        entries = entries.join(parts, PART, "left_semi")
    newest = entries.groupBy(PART).agg(F.max_by(F.struct("folder", "rows"), "version").alias("e"))
    return {r[PART]: tuple(r["e"]) for r in newest.collect()}  # a row for each part


def _folders(current: dict[int | None, tuple[str, int]]) -> list[str]:
    return [folder for folder, _ in current.values()]


def _closed_folders(spark: SparkSession, path: str, found: Sequence[Manifest]) -> list[str]:
    """Folders of closed versions: one for each batch that closed any."""
    entries = _entries(spark, path, _since(found, BASE), "closed")
    return sorted(r["folder"] for r in entries.select("folder").distinct().collect())


def _write_manifest(
    spark: SparkSession, path: str, found: Sequence[Manifest], form: str, entries: list[tuple],
    at: dt.datetime | None = None, version: int | None = None,
) -> Manifest:
    """The next manifest, complete or not there.  ``entries``: kind, part, folder, rows."""
    if version is None:
        version = found[-1].version + 1 if found else 1
    rows = spark.createDataFrame(entries, "kind string, part int, folder string, rows long")
    time = F.lit(None) if at is None else moment(at)
    stamped = rows.select(F.lit(version).cast("long").alias("version"), time.cast("timestamp").alias("at"), "*")
    name = commits.unique(f"{version:012d}-{form}")
    stamped.coalesce(1).write.json(f"{path}/manifest/{name}")
    return Manifest(version, form, name)


def _commit(
    spark: SparkSession, path: str, found: list[Manifest], fresh: list[tuple], schema: T.StructType, at: dt.datetime
) -> None:
    """A batch's changes; after ``FULL_EVERY`` of them, all current folders."""
    form = CHANGE
    if len(_since(found, FULL, BASE)) >= FULL_EVERY:
        form = FULL
        named = _current(spark, path, found) | {e[1]: e[2:] for e in fresh if e[0] == "current"}
        fresh = [e for e in fresh if e[0] != "current"] + [("current", part, *e) for part, e in named.items()]
    _write_manifest(spark, path, found, form, [*fresh, ("schema", None, schema.json(), None)], at)


# ------------------------------------------------------------------ reading


def stored_schema(spark: SparkSession, path: str, version: int | None = None) -> T.StructType | None:
    """The schema that the table was last written with, or had at a version."""
    return _schema_of(spark, path, _upto(spark, path, version))


def _schema_of(spark: SparkSession, path: str, found: Sequence[Manifest]) -> T.StructType | None:
    row = _entries(spark, path, found[-1:], "schema").select("folder").first()
    return T.StructType.fromJson(json.loads(row[0])) if row else None


def _read(spark: SparkSession, folders: list[str], schema: T.StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*folders)
    return rows.select(*cols(f.name for f in schema.fields))


def read_current(spark: SparkSession, path: str, schema: T.StructType, as_of: int | dt.datetime | None = None) -> DataFrame:
    found = _upto(spark, path, _version_at(spark, path, as_of))
    return _read(spark, _folders(_current(spark, path, found)), schema)


def read_history(spark: SparkSession, path: str, schema: T.StructType, as_of: int | dt.datetime | None = None) -> DataFrame:
    found = _upto(spark, path, _version_at(spark, path, as_of))
    return _read(spark, _closed_folders(spark, path, found), schema)


def read_published(
    spark: SparkSession, path: str, schema: T.StructType | None = None, as_of: int | dt.datetime | None = None
) -> DataFrame:
    """All versions of the rows, current and closed, as of one manifest.

    ``as_of`` is a version of the table or a time: then the newest version published up to it.  Without a
    schema the rows have the columns that the table had then.
    """
    found = _upto(spark, path, _version_at(spark, path, as_of))
    kind = schema or _schema_of(spark, path, found)
    if kind is None:
        raise ValueError(f"nothing is published at {path}")
    return _read(spark, [*_folders(_current(spark, path, found)), *_closed_folders(spark, path, found)], kind)


def published_versions(spark: SparkSession, path: str) -> DataFrame:
    """``version, at, form`` of the versions that can be read and rolled back to."""
    found = manifests(spark, path)
    forms = spark.createDataFrame([(m.version, m.form) for m in found], "version long, form string")
    return forms.join(_entries(spark, path, found, "schema").select("version", "at"), "version").select("version", "at", "form")


def _version_at(spark: SparkSession, path: str, as_of: int | dt.datetime | None) -> int | None:
    if not isinstance(as_of, dt.datetime):
        return as_of
    entries = _entries(spark, path, manifests(spark, path), "schema").where(F.col("at") <= moment(as_of))
    version = entries.agg(F.max("version")).first()[0]
    if version is None:
        raise ValueError(f"{path} had no version at {as_of}")
    return version


def published_schema(staging: DataFrame, spec: HistorySpec) -> T.StructType:
    """Schema of the table a batch of this shape publishes to."""
    loaded = first_load(staging, spec, dt.datetime(1970, 1, 1)).schema
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in loaded.fields])


# ------------------------------------------------------------------ older versions


def rollback_published(spark: SparkSession, path: str, version: int, run_ts: dt.datetime) -> int:
    """Make the table what it was at ``version``: a new version that names the folders of that one.

    Nothing is rewritten or removed, so this can be undone by rolling back to a later version.
    """
    then = _upto(spark, path, version)
    return _write_manifest(spark, path, manifests(spark, path), BASE, _all_entries(spark, path, then), run_ts).version


def _all_entries(spark: SparkSession, path: str, found: Sequence[Manifest]) -> list[tuple]:
    entries = [("current", part, *e) for part, e in _current(spark, path, found).items()]
    entries += [("closed", None, folder, None) for folder in _closed_folders(spark, path, found)]
    schema = _schema_of(spark, path, found)
    return entries + ([("schema", None, schema.json(), None)] if schema else [])


def vacuum_published(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove manifests older than the newest ``keep`` versions, and batches that no kept one names.

    The oldest kept version is first written as a ``base``, which needs none before it and stands for the
    version from then on.  What a batch that died has left goes as well, so no batch may be running.
    Returns the names of the removed folders.
    """
    if keep < 1:
        raise ValueError("at least the newest version must be kept")
    found = manifests(spark, path)
    kept, older = found[-keep:], found[:-keep]
    if not kept:
        return []
    named: set[str] = set()
    for m in kept:
        upto = [x for x in found if x.version <= m.version]
        named |= {*_folders(_current(spark, path, upto)), *_closed_folders(spark, path, upto)}
    if older and kept[0].form != BASE:
        at = _entries(spark, path, kept[:1], "schema").select("at").first()[0]
        entries = _all_entries(spark, path, [*older, kept[0]])
        kept[0] = _write_manifest(spark, path, found, BASE, entries, at, kept[0].version)
    stay = {m.name for m in kept}
    batches = {folder.removeprefix(f"{path}/batches/").split("/", 1)[0] for folder in named}
    gone = []
    for place, wanted in (("manifest", stay), ("batches", batches)):
        for name in commits.folders(spark, f"{path}/{place}"):
            if name not in wanted:
                commits.remove(spark, f"{path}/{place}/{name}")
                gone.append(name)
    return gone


# ------------------------------------------------------------------ writing


def _widened(stored: T.StructType | None, offered: T.StructType) -> T.StructType:
    """The stored columns, then new ones; a column that changes its type is an error."""
    if stored is None:
        return offered
    types = {f.name: f.dataType for f in stored.fields}
    unlike = [f.name for f in offered.fields if f.name in types and types[f.name] != f.dataType]
    if unlike:
        raise ValueError(f"columns with another type than the table's: {unlike}")
    return T.StructType([*stored.fields, *[f for f in offered.fields if f.name not in types]])


def _filled(staging: DataFrame, current: DataFrame, spec: HistorySpec, missing: list[T.StructField]) -> DataFrame:
    """A batch that lacks columns of the table: a key keeps their current values, new keys have none."""
    if not missing:
        return staging
    keys = list(key_columns(spec.keys))
    held = with_keys(current, spec.keys, spec.date_keys).select(*keys, *[quoted(f.name) for f in missing])
    return with_keys(staging, spec.keys, spec.date_keys).join(held, keys, "left")


def changed_keys(current: DataFrame, staging: DataFrame, spec: HistorySpec, part: Column) -> DataFrame:
    """One narrow row for each key of a batch: its part, its number of rows, and whether whole rows are needed.

    They are not where the key is current and all its rows carry the current marker.  Only 128-bit fingerprints of
    keys and markers and the parts are shuffled, after a partial aggregation; the keys come back as fingerprints.
    """
    keys, finger = list(key_columns(spec.keys)), ["_f1", "_f2"]
    marked = ["_m1", "_m2"]

    def narrow(df: DataFrame, brought: int, where: Column) -> DataFrame:
        keyed = with_keys(df, spec.keys, spec.date_keys)
        markers = [c.alias(m) for c, m in zip(fingerprint([spec.change_column]), marked)]
        return keyed.select(*fingerprint(keys), F.lit(brought).alias("_n"), *markers, where.alias(PART))

    found = narrow(current, 0, F.lit(None).cast("int")).unionByName(narrow(staging, 1, part)).groupBy(*finger)
    brought, old = F.col("_n") == 1, F.col("_n") == 0
    seen = {}
    for m in marked:
        seen[f"{m}_held"] = F.max(F.when(old, F.col(m)))
        seen[f"{m}_low"], seen[f"{m}_high"] = F.min(F.when(brought, F.col(m))), F.max(F.when(brought, F.col(m)))
    told = found.agg(F.sum("_n").alias("_n"), F.max(PART).alias(PART), *[c.alias(n) for n, c in seen.items()])
    same = F.lit(True)
    for m in marked:
        same = same & F.coalesce((F.col(f"{m}_low") == F.col(f"{m}_held")) & (F.col(f"{m}_high") == F.col(f"{m}_held")), F.lit(False))
    return told.where("_n > 0").select(*finger, "_n", PART, (~same).alias("_needed"))


def met_keys(current: DataFrame, staging: DataFrame, spec: HistorySpec) -> DataFrame:
    """64-bit hashes (``_f1``) of the batch's keys that are current or have several rows; of few others that share theirs.

    Only hashes with their counts are shuffled, after a partial aggregation.
    """
    keys = list(key_columns(spec.keys))

    def hashed(df: DataFrame, brought: int) -> DataFrame:
        rows = with_keys(df, spec.keys, spec.date_keys)
        return rows.select(fingerprint(keys)[0], F.lit(brought).alias("_n"), F.lit(1 - brought).alias("_held"))

    found = hashed(current, 0).unionByName(hashed(staging, 1)).groupBy("_f1")
    counted = found.agg(F.sum("_n").alias("_n"), F.max("_held").alias("_held"))
    return counted.where("_n > 0 AND (_n > 1 OR _held = 1)").select("_f1")


def _tasks(spark: SparkSession, rows: int) -> int:
    """Tasks that write rows without a shuffle: as many files of a part, so no more than keep the cores busy and the sorts small."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def publish_history(
    staging: DataFrame,
    path: str,
    spec: HistorySpec,
    run_ts: dt.datetime,
    batch: str,
    parts: int = 64,
    part: Column | None = None,
) -> Published:
    """Merge a batch into the table at ``path``.

    A key may have several rows in the batch: in the order of ``spec.order_column`` they become
    versions one after the other.  Without an order column, unlike rows of one key are refused.
    Refused rows are written beside the versions, with ``_kind`` as the reason, and counted.

    Two phases: keys with their markers alone tell which keys change (:func:`changed_keys`); whole rows are
    shuffled for these only, and the others' current rows are copied where their part is rewritten; where very many
    keys change, all rows of the touched parts are shuffled, once.  Before that, a large batch of a table with few
    parts finds the keys that meet others (:func:`met_keys`): only their rows are compared and shuffled, and a new
    row that is alone with its key is written where it is.  A part
    without a change is not touched, and a batch without any writes no rows.  ``part`` may name another
    function of the key columns, such as the month of a key date, so that hourly batches touch few parts.
    Without one, a part's files are those of the write's tasks; with one, Spark sizes them by bytes.
    """
    spark = staging.sparkSession
    generated = set(spec.generated())
    found = manifests(spark, path)
    stored = _schema_of(spark, path, found)
    schema = _widened(stored, published_schema(staging, spec))
    keys = list(key_columns(spec.keys))
    where = F.coalesce((part if part is not None else hash_part(spec, parts)).cast("int"), F.lit(NO_PART))
    everywhere = _current(spark, path, found)
    previous = sum(n for _, n in everywhere.values())
    held, offered = with_keys(_read(spark, [], schema), spec.keys, spec.date_keys), with_keys(staging, spec.keys, spec.date_keys)
    theirs, copied, alone, unchanged = held, None, None, 0
    hashed = fingerprint(keys)[0]
    batch_rows, many = {}, False
    if everywhere or (part is None and parts <= FEW_PARTS):
        batch_rows = {r[PART]: r["count"] for r in staging.groupBy(where.alias(PART)).count().collect()}  # a row for each part
        many = part is None and parts <= FEW_PARTS and sum(batch_rows.values()) > FEW_KEYS
    here = _read(spark, [everywhere[p][0] for p in batch_rows if p in everywhere], schema)
    met = lambda df: df
    if many:
        compared = sum(n + everywhere.get(p, ("", 0))[1] for p, n in batch_rows.items())
        size = max(BITMAP, min(MOST_BITS, 1 << (BITS_A_ROW * compared).bit_length()))
        told = scratch_path(spark, "met-keys")
        bit_filter(met_keys(here, staging, spec), "_f1", size).write.parquet(told)
        bits = spark.read.parquet(told)
        met = lambda df: by_bit(df, bits, size, hashed, True)
        missed = lambda df, n: by_bit(df, bits, size, hashed, False).coalesce(_tasks(spark, n))
    lone = dict(batch_rows) if many else {}
    if everywhere:
        told = scratch_path(spark, "changed-keys")
        seen = [met(with_keys(df, spec.keys, spec.date_keys)) for df in (here, staging)]
        changed_keys(*seen, spec, where).write.parquet(told)
        told = spark.read.parquet(told)
        sums = told.groupBy(PART).agg(
            F.sum(F.when(~F.col("_needed"), F.col("_n"))).alias("unchanged"), F.count_if("_needed").alias("touched"), F.sum("_n").alias("n")
        )
        sums = {r[PART]: r for r in sums.collect()}  # a row for each part
        lone = {p: n - (sums[p]["n"] if p in sums else 0) for p, n in lone.items()}
        unchanged = sum(r["unchanged"] or 0 for r in sums.values())
        touched = [p for p in batch_rows if (p in sums and sums[p]["touched"]) or lone.get(p)]
        if not touched:
            if stored != schema:
                _commit(spark, path, found, [], schema, run_ts)
            return Published(schema, 0, 0, 0, unchanged, 0, 0, None, previous)
        theirs = held = with_keys(_read(spark, [everywhere[p][0] for p in touched if p in everywhere], schema), spec.keys, spec.date_keys)
        held_rows = sum(everywhere[p][1] for p in touched if p in everywhere)
        alone = missed(offered, sum(lone.values())) if many else None
        if part is not None or sum(r["touched"] for r in sums.values()) <= FEW_KEYS:
            needed = told.where("_needed").select("_f1", "_f2")
            among = lambda df, how: df.select("*", *fingerprint(keys)).join(needed, ["_f1", "_f2"], how).drop("_f1", "_f2")
            theirs, offered = among(held, "left_semi"), among(offered, "left_semi")
            copied = among(held, "left_anti")
        else:  # three joins would shuffle more than the rows themselves
            theirs, offered = met(held), met(offered.where(where.isin(touched)))
            copied = missed(held, held_rows) if many else None
            unchanged = sum(r["unchanged"] or 0 for p, r in sums.items() if p not in touched)
    elif many:
        offered, alone = met(offered), missed(offered, sum(lone.values()))
    given = set(staging.columns)
    missing = [f for f in schema.fields if f.name not in given and f.name not in generated]
    offered = _filled(offered, theirs, spec, missing)
    names = [quoted(f.name) for f in schema.fields if f.name not in generated]
    offered = offered.select(*keys, *names)
    # of one part, pieces of the key's hash: a task has few of them, so it writes few files
    spread = [PART, "_piece"] if part is None else []
    if spread:
        piece = F.pmod(F.xxhash64(F.lit("piece"), *keys), F.lit(max(1, PIECES // parts)))
        theirs, offered = (df.withColumns({PART: where, "_piece": piece}) for df in (theirs, offered))
    rows = versions_of_batch(theirs, offered, spec, run_ts, spread).drop(*spread)
    if copied is not None:
        rows = rows.unionByName(copied.drop(*keys).withColumns({"_kind": F.lit("current"), "_brought": F.lit(False)}))
    if alone is not None:
        alone = alone.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}).select(*names)
        rows = rows.unionByName(versions_alone(alone, spec, run_ts))
    rows = rows.withColumn(PART, where).withColumn("kind", F.col("_kind"))
    home = f"{path}/batches/{commits.unique(batch)}"
    rows = rows if spread else rows.hint("rebalance", "kind", PART)
    rows.write.partitionBy("kind", PART).option("compression", CODEC).parquet(home)

    written = spark.read.schema(
        T.StructType([*schema.fields, T.StructField("_kind", T.StringType()), T.StructField("_brought", T.BooleanType()), T.StructField("kind", T.StringType()), T.StructField(PART, T.IntegerType())])
    ).parquet(home)
    counted = written.groupBy("kind", PART).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("_brought").alias("brought"),
    )
    counted = counted.collect()  # a row for each part and kind
    total = lambda kind, column="n": sum(r[column] for r in counted if r["kind"] == kind)
    fresh = [("current", r[PART], f"{home}/kind=current/{PART}={r[PART]}", r["n"]) for r in counted if r["kind"] == "current"]
    fresh += [("closed", None, f"{home}/kind=closed", total("closed"))] if total("closed") else []
    _commit(spark, path, found, fresh, schema, run_ts)
    updated = total("closed") - total("closed", "brought")  # each changed key had one current row
    brought = total("current", "brought") + total("closed", "brought")
    refused = {kind: total(kind) for kind in ("stale", "conflict")}
    return Published(
        schema=schema,
        inserted=total("current", "brought") - updated,
        updated=updated,
        versions=brought,
        unchanged=unchanged + total("unchanged"),
        stale=refused["stale"],
        conflicts=refused["conflict"],
        rejects=home,
        previous=previous,
    )


def publish_full(staging: DataFrame, path: str, batch: str, run_ts: dt.datetime | None = None) -> Published:
    """Replace the table by the batch, in the table's columns and types; readers see the old or the new one."""
    spark = staging.sparkSession
    found = manifests(spark, path)
    stored = _schema_of(spark, path, found)
    rows = staging
    if stored is not None:
        kinds = [(f.name, f.dataType) for f in stored.fields]
        lacking = [name for name, _ in kinds if name not in staging.columns]
        rows = staging.withColumns({n: F.lit(None) for n in lacking}) if lacking else staging
        rows = rows.select(*[F.col(quoted(name)).cast(kind).alias(name) for name, kind in kinds])
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields])
    home = f"{path}/batches/{commits.unique(batch)}"
    rows.write.option("compression", CODEC).parquet(home)
    count = spark.read.schema(schema).parquet(home).count()
    before = sum(n for _, n in _current(spark, path, found).values())
    _write_manifest(spark, path, found, BASE, [("current", None, home, count), ("schema", None, schema.json(), None)], run_ts)
    return Published(schema, count, 0, count, 0, 0, 0, home, previous=before)


def publish_snapshot(
    rows: DataFrame, path: str, batch: str, run_ts: dt.datetime, date_column: str = "snapshot_date"
) -> Published:
    """Add the snapshots of the days in ``rows``, or replace those of the same days; all of them or none."""
    spark = rows.sparkSession
    found = manifests(spark, path)
    stored = _schema_of(spark, path, found)
    schema = _widened(stored, T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields]))
    home = f"{path}/batches/{commits.unique(batch)}"
    day = F.coalesce(F.date_format(quoted(date_column), "yyyyMMdd").cast("int"), F.lit(NO_PART))
    rows.withColumn(PART, day).hint("rebalance", PART).write.partitionBy(PART).option("compression", CODEC).parquet(home)
    counted = spark.read.schema(T.StructType([*schema.fields, T.StructField(PART, T.IntegerType())])).parquet(home)
    counted = counted.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each day
    previous = sum(n for _, n in _current(spark, path, found).values())
    _commit(spark, path, found, [("current", r[PART], f"{home}/{PART}={r[PART]}", r["n"]) for r in counted], schema, run_ts)
    count = sum(r["n"] for r in counted)
    return Published(schema, count, 0, count, 0, 0, 0, home, previous)


def read_refused(spark: SparkSession, done: Published) -> DataFrame:
    """The batch's rows that became no version, with the reason in ``_kind`` (unchanged ones left out)."""
    fields = [*done.schema.fields, T.StructField("_kind", T.StringType()), T.StructField("kind", T.StringType())]
    if done.rejects is None:
        return spark.createDataFrame([], T.StructType(fields[:-1]))
    rows = spark.read.schema(T.StructType(fields)).parquet(done.rejects)
    return rows.where(F.col("kind").isin("stale", "conflict")).drop("kind")
