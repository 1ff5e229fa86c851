"""The gate: from a rule file and a date to accepted rows, rejects and audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from sift.functions import names
from sift.functions.coerce import lenient_cast
from sift.operators import audit, split
from sift.operators.keys import one_per_key
from sift.operators.rules import configured_rules, malformed_rule
from sift.operators.shape import cast_columns, cast_losses, loss_columns, project_columns
from sift.operators.tally import Tally, tally
from sift.plans.sizing import staging_settings
from sift.sources import tables
from sift.sources.paths import GatePaths, table_name
from sift.sources.publish import Publication, finish, journal_path, overlapping, plain
from sift.sources.rulefile import (
    CHECK_COLUMN,
    CHECKED_COLUMN,
    ConfigError,
    GateConfig,
    load_config,
    load_folder,
)
from sift.sources.scratch import drop_path, scratch_path


@dataclass(frozen=True)
class Gate:
    """The gate over one table, nothing computed yet."""

    config: GateConfig
    tally: Tally
    source: DataFrame
    explain: bool = False
    key: Key | None = None
    hidden: tuple[str, ...] = ()  # columns that `*` doesn't stand for

    def split(self) -> Tally:
        """The tally, with rows failed that lose their key to another one."""
        if self.key is None:
            return self.tally
        return one_per_key(self.tally, self.key.columns, self.key.latest)

    def accepted(self) -> DataFrame:
        """Accepted rows, cast and projected as declared."""
        return project_columns(self.accepted_cast().drop(*self.hidden), self.config.required_cols)

    def accepted_cast(self) -> DataFrame:
        return cast_columns(split.accepted_rows(self.split()), self.config.cols_datatype)

    def rejects(self) -> DataFrame:
        ledger = split.explained_ledger if self.explain else split.reject_ledger
        return ledger(self.split())

    def counts(self) -> DataFrame:
        return audit.counts(self.split())

    def audit(self, table: str) -> DataFrame:
        return audit.audit_row(self.counts(), table)

    def cast_losses(self) -> DataFrame:
        """How many accepted rows lose a value to each declared cast."""
        return cast_losses(self.split(), self.source, self.config.cols_datatype)

    def stage(self, path: str) -> Gate:
        """Store the tally below `path`, and count while it is written.

        Keys take a second table: their join reads the first one twice.
        """
        tally = self.tally
        if self.key is not None:
            tally = replace(self, tally=tally.stage(f"{path}/rows")).split()
        losses = loss_columns(tally, self.source, self.config.cols_datatype)
        watched = audit.count_columns() | {f"loss{at}": c for at, c in enumerate(losses.values())}
        return replace(self, tally=tally.stage(f"{path}/tally", watched), key=None)

    def metrics(self) -> dict[str, int]:
        """The counts: as observed by `stage`, else by a job."""
        seen = self.tally.counted
        if seen is None or not seen.keys() >= audit.count_columns().keys():
            return self.counts().first().asDict()
        return {name: seen[name] for name in audit.count_columns()}

    def losses(self) -> dict[str, int]:
        """Values that the declared casts of accepted rows lose, by column."""
        seen, casts = self.tally.counted or {}, self.config.cols_datatype
        if all(f"loss{at}" in seen for at in range(len(casts))):
            return {names.bare(name): seen[f"loss{at}"] for at, name in enumerate(casts)}
        return {row.column_name: row.losses for row in self.cast_losses().collect()}


@dataclass(frozen=True)
class Key:
    """Columns of which the accepted rows have each combination once."""

    columns: tuple[str, ...]
    latest: tuple[Column, ...]


def plan_gate(
    source: DataFrame,
    config: GateConfig,
    *,
    semantics: str = "legacy",
    latest_by: Sequence[str] | None = None,
    malformed: str | None = None,
    explain: bool = False,
) -> Gate:
    """Check the rules against the source and lay out the tally; runs no job.

    `latest_by` puts `duplicate_check` to use, which else has no effect: of the
    passing rows that agree in its columns, the one with the largest values in
    `latest_by` (as the type it is cast to, if any) is accepted. `malformed`
    names a column whose rows are rejected where it isn't NULL; it is no part
    of `*`. `explain` adds the check and the column to the ledger.
    """
    exact_case = names.case_sensitive(source.sparkSession)
    config.validate(source.schema, case_sensitive=exact_case)
    rules = configured_rules(
        config, source.schema, semantics=semantics, case_sensitive=exact_case
    )
    if malformed is not None:
        rules = [malformed_rule(malformed), *rules]
    if explain:
        refuse_columns(source, (CHECK_COLUMN, CHECKED_COLUMN), exact_case)
    counted = tally(source, rules, by_rule=explain)
    key = None if latest_by is None else planned_key(counted, source, config, latest_by)
    hidden = () if malformed is None else (malformed,)
    return Gate(config, counted, source, explain, key, hidden)


def refuse_columns(source: DataFrame, added: Sequence[str], exact_case: bool) -> None:
    for name in added:
        if names.find(name, source.columns, exact_case) is not None:
            raise ConfigError(f"the source has a column called {name!r}")


def planned_key(
    counted: Tally, source: DataFrame, config: GateConfig, latest_by: Sequence[str]
) -> Key:
    """The columns of `duplicate_check`, and what the latest row has most of."""
    exact_case = names.case_sensitive(source.sparkSession)
    listed = config.duplicate_check
    if not isinstance(listed, (list, tuple)) or not listed:
        raise ConfigError(f"'duplicate_check' must list the key's columns, not {listed!r}")

    def field(name: object) -> T.StructField:
        at = names.find(name, source.columns, exact_case) if isinstance(name, str) else None
        if at is None:
            raise ConfigError(f"the key or its order names unknown column {name!r}")
        return source.schema[at]

    casts = {field(name).name: kind for name, kind in config.cols_datatype.items()}

    def order(name: str) -> Column:
        found = field(name)
        value = counted.position(found.name)
        kind = casts.get(found.name)
        return lenient_cast(value, found.dataType, kind) if kind else value

    keys = tuple(dict.fromkeys(field(name).name for name in listed))
    return Key(keys, tuple(map(order, latest_by)))


@dataclass(frozen=True)
class GateResult:
    """What a run wrote: the outputs as stored, and the counts."""

    table: str
    paths: GatePaths
    metrics: dict[str, int]
    cast_losses: dict[str, int]
    loaded: datetime
    accepted: DataFrame
    rejects: DataFrame
    audit: DataFrame


# The column that holds lines which don't fit the header, where they are rejected.
MALFORMED_LINE = "malformed_line"


def run_gate(
    spark: SparkSession,
    config_filepath: str,
    processed_date: str = "",
    *,
    source: DataFrame | None = None,
    semantics: str = "legacy",
    strict: bool = True,
    faithful_rejects: bool = False,
    source_bytes: int | None = None,
    latest_by: Sequence[str] | None = None,
    reject_malformed: bool = False,
    explain: bool = False,
) -> GateResult:
    """Run the gate for one table and date and write its three outputs.

    The source is read and shuffled once; the tally is stored in shared
    storage and counted on the way, and the outputs are read off it without
    another shuffle. So they agree with each other even if source files change
    meanwhile, and a lost executor costs its tasks only. `source` replaces the
    CSV landing folder by any other table, `source_bytes` tells its size if
    Spark does not know it. All outputs are planned and checked before the
    first job.

    The three outputs are written to hidden folders and take their places
    together at the end; until then, the old ones stay as they are. What an
    interrupted run had yet to move is moved first.

    `reject_malformed` rejects lines of the landing folder with too few or too
    many fields, and keeps them, in one more column of the ledger;
    `latest_by` and `explain` are those of `plan_gate`.
    """
    config = load_config(spark, config_filepath, strict=strict)
    return run_configured(
        spark,
        config,
        table_name(config_filepath),
        processed_date,
        source=source,
        semantics=semantics,
        faithful_rejects=faithful_rejects,
        source_bytes=source_bytes,
        latest_by=latest_by,
        reject_malformed=reject_malformed,
        explain=explain,
    )


def run_configured(
    spark: SparkSession,
    config: GateConfig,
    table: str,
    processed_date: str = "",
    *,
    source: DataFrame | None = None,
    semantics: str = "legacy",
    faithful_rejects: bool = False,
    source_bytes: int | None = None,
    latest_by: Sequence[str] | None = None,
    reject_malformed: bool = False,
    explain: bool = False,
) -> GateResult:
    """`run_gate` for a rule file that has been read."""
    paths = config.paths(processed_date)
    outputs = (paths.target, paths.pending, paths.audit)
    if same := overlapping(outputs):
        raise ConfigError(f"two outputs would be written to {same[0]}")
    malformed = MALFORMED_LINE if reject_malformed and source is None else None
    if source is None:
        source = tables.read_csv(spark, paths.source, malformed=malformed)
    gate = plan_gate(
        source,
        config,
        semantics=semantics,
        latest_by=latest_by,
        malformed=malformed,
        explain=explain,
    )
    check_outputs(gate)

    staging = scratch_path(spark, f"tally-{table}")
    refuse_overlap(staging, paths)
    finish(spark, journal_path(outputs))
    new = Publication(spark, outputs)
    try:
        with staging_settings(spark, source, source_bytes):
            stored = gate.stage(staging)
        metrics, losses = stored.metrics(), stored.losses()
        loaded = datetime.now(timezone.utc)

        accepted = stored.accepted()
        rejects = stored.rejects()
        record = audit.fixed_audit_row(spark, {**metrics, "loadtimestamp": loaded}, table)
        tables.write_parquet(accepted, new.place(paths.target))
        tables.write_csv(rejects, new.place(paths.pending), faithful=faithful_rejects)
        tables.write_csv(record, new.place(paths.audit))
        new.commit()
    except BaseException:
        new.abandon()
        raise
    finally:
        drop_path(spark, staging)

    return GateResult(
        table,
        paths,
        metrics,
        losses,
        loaded,
        accepted=spark.read.schema(accepted.schema).parquet(paths.target),
        rejects=tables.read_csv(
            spark, paths.pending, schema=rejects.schema, faithful=faithful_rejects
        ),
        audit=tables.read_csv(spark, paths.audit, schema=record.schema),
    )


def run_folder(
    spark: SparkSession,
    folder: str,
    processed_date: str = "",
    *,
    sources: Mapping[str, DataFrame] | None = None,
    strict: bool = True,
    **options: Any,
) -> dict[str, GateResult]:
    """Run the gate for every rule file in a folder, one table after the other.

    All rule files are read in one scan and checked before the first run. A
    table that fails doesn't keep the others from running; its error is
    raised at the end, with those of other tables. `sources` replaces landing
    folders by table name; other options are those of `run_gate`.
    """
    configs = load_folder(spark, folder, strict=strict)
    results, errors = {}, []
    for table, config in configs.items():
        source = (sources or {}).get(table)
        try:
            results[table] = run_configured(
                spark, config, table, processed_date, source=source, **options
            )
        except Exception as error:
            error.add_note(f"table {table}")
            errors.append(error)
    if errors:
        raise ExceptionGroup(f"{len(errors)} of {len(configs)} tables failed", errors)
    return results


def check_outputs(gate: Gate) -> None:
    """Plan both row outputs, which runs no job, and see that they can be written."""
    problems = []
    for what, plan, fits in (
        ("accepted rows", gate.accepted, _fits_parquet),
        ("reject ledger", gate.rejects, _fits_csv),
    ):
        try:
            schema = plan().schema
        except PySparkException as refused:
            problems.append(f"{what}: {str(refused).splitlines()[0]}")
            continue
        problems += [
            f"{what}: column {f.name!r} of type {f.dataType.simpleString()} cannot be written"
            for f in schema
            if not fits(f.dataType)
        ]
    if problems:
        raise ConfigError("; ".join(problems))


def _fits_csv(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.AtomicType) and not isinstance(dtype, (T.VariantType, T.BinaryType))


def _fits_parquet(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _fits_parquet(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _fits_parquet(dtype.keyType) and _fits_parquet(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return len(dtype) > 0 and all(_fits_parquet(f.dataType) for f in dtype)
    return not isinstance(dtype, (T.NullType, T.CalendarIntervalType))


def refuse_overlap(staging: str, paths: GatePaths) -> None:
    """Overwriting a path must not delete the staged table, nor the other way round."""
    place = plain(staging)
    for path in (paths.source, paths.target, paths.pending, paths.audit):
        other = plain(path)
        if place.startswith(other) or other.startswith(place):
            raise ConfigError(
                f"the staging folder {staging} and {path} overlap; set spark.checkpoint.dir "
                "to a folder outside all paths of the rule file"
            )
