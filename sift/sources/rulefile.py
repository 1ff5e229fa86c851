"""The JSON rule file: one document that says what to read, test and write."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sift.functions import names
from sift.functions.coerce import DATE_TYPES, TEXT_TYPES
from sift.sources.paths import GatePaths, dated, table_name_column

# The keys of the rule file.
PATH_KEYS = ("sourcefile", "targetfile", "pendingfile", "auditfile")
LIST_KEYS = ("required_cols", "null_check", "dateformatchecks", "no_negative_value")
UNUSED_KEY = "duplicate_check"  # must be there, has no effect
CAST_KEY = "cols_datatype"  # may be left out: Spark drops empty structs on reading

# Fixed value: stands for all columns of the source in `required_cols`.
ALL_COLUMNS = "*"

# Fixed value: the column the reject ledger adds.
REASON_COLUMN = "reject_reason"

# What an explained ledger adds to it: the check that failed, and its column.
CHECK_COLUMN, CHECKED_COLUMN = "reject_check", "reject_column"


class ConfigError(ValueError):
    """The rule file does not fit its contract or the source table."""


@dataclass(frozen=True)
class GateConfig:
    sourcefile: str
    targetfile: str
    pendingfile: str
    auditfile: str
    required_cols: tuple[str, ...]
    null_check: tuple[str, ...] = ()
    dateformatchecks: tuple[str, ...] = ()
    no_negative_value: tuple[str, ...] = ()
    cols_datatype: Mapping[str, str] = field(default_factory=dict)
    duplicate_check: Any = None

    @classmethod
    def from_mapping(cls, raw: Mapping[str, Any], *, strict: bool = True) -> GateConfig:
        """Check the document's shape; all problems come in one error.

        `strict` refuses keys the contract does not know (a misspelt
        `cols_datatype` would otherwise pass for "no casts").
        """
        needed = (*PATH_KEYS, *LIST_KEYS, UNUSED_KEY)
        problems = [f"missing key {key!r}" for key in needed if key not in raw]
        if strict:
            problems += [
                f"unknown key {key!r}" for key in raw if key not in needed and key != CAST_KEY
            ]
        problems += [
            f"{key!r} must be text, not {raw[key]!r}"
            for key in PATH_KEYS
            if key in raw and not isinstance(raw[key], str)
        ]
        problems += [
            f"{key!r} must be an array of column names, not {raw[key]!r}"
            for key in LIST_KEYS
            if key in raw and not _is_name_list(raw[key])
        ]
        casts, cast_problems = _casts(raw.get(CAST_KEY))
        problems += cast_problems
        if not problems and not raw["required_cols"]:
            problems.append("'required_cols' is empty: nothing would be written")
        if problems:
            raise ConfigError("; ".join(problems))
        return cls(
            **{key: raw[key] for key in PATH_KEYS},
            **{key: tuple(raw[key]) for key in LIST_KEYS},
            cols_datatype=casts,
            duplicate_check=raw[UNUSED_KEY],
        )

    def paths(self, processed_date: str) -> GatePaths:
        return GatePaths(*(dated(getattr(self, key), processed_date) for key in PATH_KEYS))

    def validate(self, schema: T.StructType, *, case_sensitive: bool = False) -> None:
        """Check every configured name and type against the source, before any job."""
        columns = schema.names
        problems = []
        if names.find(REASON_COLUMN, columns, case_sensitive) is not None:
            problems.append(f"the source has a column called {REASON_COLUMN!r}")
        for key in (*LIST_KEYS, CAST_KEY):
            for name in getattr(self, key):
                if key == "required_cols" and name == ALL_COLUMNS:
                    continue
                if names.find(name, columns, case_sensitive) is None:
                    problems.append(f"{key!r} names unknown column {name!r}")
        wanted = expand_all(self.required_cols, columns)
        for key, listed in (("required_cols", wanted), (CAST_KEY, self.cols_datatype)):
            for name in names.repeated(listed, case_sensitive):
                problems.append(f"{key!r} names column {name!r} twice")
        for key, allowed, what in (
            ("no_negative_value", (*TEXT_TYPES, T.NumericType), "a number"),
            ("dateformatchecks", (*TEXT_TYPES, *DATE_TYPES), "a date"),
        ):
            for name in getattr(self, key):
                at = names.find(name, columns, case_sensitive)
                if at is not None and not isinstance(schema[at].dataType, allowed):
                    kind = schema[at].dataType.simpleString()
                    problems.append(f"{key!r}: column {name!r} of type {kind} is not {what}")
        for name, type_name in self.cols_datatype.items():
            if not _is_type_name(type_name):
                problems.append(f"{CAST_KEY!r}: {type_name!r} for {name!r} is no type name")
        if problems:
            raise ConfigError("; ".join(problems))


def expand_all(wanted: Sequence[str], columns: Sequence[str]) -> list[str]:
    """The wanted columns with `*` replaced by all columns of the source."""
    named = {name: "`" + name.replace("`", "``") + "`" for name in columns}
    return [
        name
        for listed in wanted
        for name in ([named[c] for c in columns] if listed == ALL_COLUMNS else [listed])
    ]


def _is_type_name(text: str) -> bool:
    """Whether a cast takes it; a list of fields also parses, as a struct."""
    try:
        dtype = T.DataType.fromDDL(text)
    except Exception:
        return False
    return not isinstance(dtype, T.StructType) or text.strip().lower().startswith("struct<")


def _is_name_list(value: Any) -> bool:
    return isinstance(value, (list, tuple)) and all(isinstance(v, str) for v in value)


def _casts(value: Any) -> tuple[dict[str, str], list[str]]:
    """The first struct of the array as {column: type}; none of it means no casts.

    Spark merges the schemas of several structs, so fields that belong to a
    later struct come back as None in the first and are left out.
    """
    if isinstance(value, (list, tuple)):
        value = value[0] if value else None
    if value is None:
        return {}, []
    if not isinstance(value, Mapping):
        return {}, [f"{CAST_KEY!r} must be an array holding one object, not {value!r}"]
    casts = {name: kind for name, kind in value.items() if kind is not None}
    wrong = {name: kind for name, kind in casts.items() if not isinstance(kind, str)}
    return casts, [f"{CAST_KEY!r}: type of {name!r} must be text" for name in wrong]


def load_config(spark: SparkSession, path: str, *, strict: bool = True) -> GateConfig:
    """Read a rule file; of a top-level array the first document counts."""
    documents = spark.read.option("multiLine", True).json(path)
    if "_corrupt_record" in documents.columns:
        raise ConfigError(f"{path} is not valid JSON")
    first = documents.first()
    if first is None:
        raise ConfigError(f"no rule document in {path}")
    return GateConfig.from_mapping(first.asDict(recursive=True), strict=strict)


def load_folder(spark: SparkSession, folder: str, *, strict: bool = True) -> dict[str, GateConfig]:
    """The rule files (`*.json`) of a folder, by the table that each file names.

    One scan reads them all, each as one value beside the path it came from;
    a schema for all of them at once would mix their keys. Of a top-level
    array the first document counts. Problems of all files come in one error.
    """
    path = F.col("_metadata.file_path")
    files = (
        spark.read.option("pathGlobFilter", "*.json")
        .text(folder, wholetext=True)
        .select(
            path.alias("path"),
            table_name_column(F.col("_metadata.file_name")).alias("table"),
            F.try_parse_json("value").alias("document"),
        )
        .orderBy("path")
        .collect()
    )
    found: dict[str, GateConfig] = {}
    problems = [] if files else [f"no rule files in {folder}"]
    for file in files:
        document = file.document.toPython() if file.document is not None else None
        if isinstance(document, list):
            document = document[0] if document else None
        try:
            if not isinstance(document, Mapping):
                raise ConfigError("no rule document")
            if file.table in found:
                raise ConfigError(f"a second file for table {file.table!r}")
            found[file.table] = GateConfig.from_mapping(document, strict=strict)
        except ConfigError as problem:
            problems.append(f"{file.path}: {problem}")
    if problems:
        raise ConfigError("; ".join(problems))
    return found
