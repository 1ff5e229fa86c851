"""The catalogue: name -> Spark query, and name -> the same query in SQL.

The SQL is written from the definitions (window, union of branches, set
difference), the Spark side from the tally, so each checks the other.

Queries about files write them to fresh paths in the shared scratch folder and
leave them there, as the returned DataFrame reads them later.
"""

from __future__ import annotations

import json
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sift import load_config, plan_gate, run_folder, run_gate
from sift.functions import coerce
from sift.operators import audit, rules, split
from sift.operators.tally import Tally, failures_by_rule, tally
from sift.plans.gate import Gate, GateResult
from sift.sources import paths, publish, tables
from sift.sources.rulefile import PATH_KEYS, GateConfig
from workload.dirty_orders import (
    COLUMNS,
    DIRTY_SQL,
    dirty_orders,
    fresh_root,
    orders_config,
    rule_document,
    write_rule_file,
)

DATE = "1998/08/10"
PREFIX = "/lake"


def orders_gate(spark: SparkSession, sf_dir: str, semantics: str = "legacy") -> Gate:
    return plan_gate(dirty_orders(spark, sf_dir), orders_config(), semantics=semantics)


def orders_tally(spark: SparkSession, sf_dir: str, semantics: str = "legacy") -> Tally:
    return orders_gate(spark, sf_dir, semantics).tally


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- sources -------------------------------------------------------------


def csv_scan_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_root(spark, "landing")
    tables.write_csv(dirty_orders(spark, sf_dir), path)
    return tables.read_csv(spark, path)


def csv_scan_headerless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header line read without the header option is a data row."""
    path = fresh_root(spark, "landing")
    tables.write_csv(dirty_orders(spark, sf_dir), path, header=False)
    line = spark.createDataFrame([COLUMNS], ", ".join(f"{c} string" for c in COLUMNS))
    line.write.mode("append").csv(path)
    return tables.read_csv(spark, path, header=False)


def config_rule_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule file's (check, column) pairs and how many rows each one fails."""
    path = f"{fresh_root(spark, 'rules')}/orders.json"
    write_rule_file(spark, rule_document(PREFIX), path)
    config = load_config(spark, path)
    source = dirty_orders(spark, sf_dir)
    key_of = {
        rules.NULL: "null_check",
        rules.NEGATIVE: "no_negative_value",
        rules.BAD_DATE: "dateformatchecks",
    }
    configured = rules.configured_rules(config, source.schema)
    labelled = [(key_of[rule.reason], rule) for rule in configured]
    return failures_by_rule(tally(source, configured), labelled)


def dated_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four paths of every order date, with the rows that date would hold."""
    day = F.date_format("o_orderdate", "yyyy/MM/dd").alias("processed_date")
    config = orders_config(PREFIX)
    return (
        table(spark, sf_dir, "orders")
        .groupBy(day)
        .agg(F.count(F.lit(1)).alias("orders"))
        .select(
            "processed_date",
            "orders",
            *(
                paths.dated_column(getattr(config, key), F.col("processed_date")).alias(name)
                for key, name in (
                    ("sourcefile", "source_path"),
                    ("targetfile", "target_path"),
                    ("pendingfile", "pending_path"),
                    ("auditfile", "audit_path"),
                )
            ),
        )
    )


def table_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", paths.table_name_column(F.col("url")).alias("tablename")
    )


# --- duplicates and rules ------------------------------------------------


def duplicate_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.rank_duplicates(orders_tally(spark, sf_dir))


def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.duplicate_rows(orders_tally(spark, sf_dir))


def unique_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.unique_rows(orders_tally(spark, sf_dir))


def null_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.rule_rejects(orders_tally(spark, sf_dir), rules.NULL)


def negative_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.rule_rejects(orders_tally(spark, sf_dir), rules.NEGATIVE)


def negative_rejects_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.rule_rejects(orders_tally(spark, sf_dir, "exact"), rules.NEGATIVE)


def date_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.rule_rejects(orders_tally(spark, sf_dir), rules.BAD_DATE)


def reject_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_gate(spark, sf_dir).rejects()


def reject_ledger_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_gate(spark, sf_dir, "exact").rejects()


def reject_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.reason_counts(orders_tally(spark, sf_dir))


# --- accepted rows and counts --------------------------------------------


def accepted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.accepted_rows(orders_tally(spark, sf_dir))


def accepted_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_gate(spark, sf_dir).accepted_cast()


def accepted_projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_gate(spark, sf_dir).accepted()


def accepted_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`*` among the required columns stands for all of them."""
    config = replace(orders_config(), required_cols=("*",))
    return plan_gate(dirty_orders(spark, sf_dir), config).accepted()


def gate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_gate(spark, sf_dir).audit("orders").drop("loadtimestamp")


def gate_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = orders_gate(spark, sf_dir).counts()
    return counted.select(
        "sourcecount",
        "uniquecount",
        "rejectcount",
        "writtencount",
        "overlap",
        (
            F.col("sourcecount")
            == F.col("rejectcount") + F.col("writtencount") - F.col("overlap")
        ).alias("reconciles"),
    )


# --- casts on text derived from the tables -------------------------------

# Texts of every line's price: signed, padded, with and without a fraction.
_PRICE_TEXTS = {
    "cut": lambda price: F.concat(F.lit(" -"), price, F.lit("\t")),
    "plain": lambda price: F.concat(F.lit("+"), F.substring_index(price, ".", 1)),
    "exponent": lambda price: F.concat(price, F.lit("e1")),
    "words": lambda price: F.concat(price, F.lit(" EUR")),
}


def text_to_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        *(coerce.integer(text(price)).alias(name) for name, text in _PRICE_TEXTS.items()),
        coerce.integer(_PRICE_TEXTS["cut"](price), "smallint").alias("cut_smallint"),
    )


# --- sinks and the whole job ---------------------------------------------


def sink_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = orders_gate(spark, sf_dir).accepted()
    path = fresh_root(spark, "target")
    tables.write_parquet(accepted, path)
    return spark.read.schema(accepted.schema).parquet(path)


def sink_reject_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_root(spark, "pending")
    tables.write_csv(orders_gate(spark, sf_dir).rejects(), path)
    return tables.read_csv(spark, path)


def sink_audit_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_root(spark, "audit")
    tables.write_csv(orders_gate(spark, sf_dir).audit("orders"), path)
    return tables.read_csv(spark, path).drop("loadtimestamp")


def _run_orders(spark: SparkSession, sf_dir: str) -> GateResult:
    """The whole job over a table, from a landing folder of its own."""
    root = fresh_root(spark, "gate")
    document = rule_document(root)
    tables.write_csv(
        dirty_orders(spark, sf_dir), paths.dated(document["sourcefile"], DATE)
    )
    write_rule_file(spark, document, f"{root}/rules/orders.json")
    return run_gate(spark, f"{root}/rules/orders.json", DATE)


def gate_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_orders(spark, sf_dir).accepted


def gate_end_to_end_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_orders(spark, sf_dir).rejects


def gate_end_to_end_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_orders(spark, sf_dir).audit.drop("loadtimestamp")


def faithful_reject_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents rejected, written faithfully and read back as they were."""
    root = fresh_root(spark, "faithful")
    document = rule_document(root) | {
        "required_cols": ["doc_id"],
        "null_check": [],
        "no_negative_value": [],
        "dateformatchecks": ["lang"],
        "cols_datatype": [],
    }
    write_rule_file(spark, document, f"{root}/rules/documents.json")
    source = table(spark, sf_dir, "documents")
    rules_at = f"{root}/rules/documents.json"
    return run_gate(spark, rules_at, DATE, source=source, faithful_rejects=True).rejects


def rule_folder_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule file of a folder run; the audits of all tables."""
    root = fresh_root(spark, "folder")
    orders = rule_document(root)
    tables.write_csv(dirty_orders(spark, sf_dir), paths.dated(orders["sourcefile"], DATE))
    publish.write_text(spark, f"{root}/rules/orders.v2.json", json.dumps(orders))
    typed = {"customer": _CUSTOMER, "supplier": _SUPPLIER}
    for name, config in typed.items():
        document = {
            key: list(value) if isinstance(value, tuple) else value
            for key, value in vars(config).items()
            if key != "cols_datatype"
        }
        places = {key: f"{root}/{key}/{name}/" for key in PATH_KEYS}
        casts = [dict(config.cols_datatype)] if config.cols_datatype else []
        text = json.dumps([document | places | {"duplicate_check": [], "cols_datatype": casts}])
        publish.write_text(spark, f"{root}/rules/{name}.json", text)
    sources = {name: table(spark, sf_dir, name) for name in typed}
    results = run_folder(spark, f"{root}/rules", DATE, sources=sources)
    audits = [result.audit.drop("loadtimestamp") for result in results.values()]
    return reduce(DataFrame.unionByName, audits)


# --- malformed lines, keys, explained rejects, lost values ---------------


def malformed_line_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a field too few or too many among the orders."""
    path = fresh_root(spark, "lines")
    number = F.col("order_id").cast("bigint")
    fields = [F.coalesce(c, F.lit("")) for c in COLUMNS]
    line = (
        F.when(number % 37 == 0, F.concat_ws(",", *fields[:-1]))
        .when(number % 43 == 0, F.concat_ws(",", *fields, F.lit("surplus")))
        .otherwise(F.concat_ws(",", *fields))
    )
    dirty_orders(spark, sf_dir).select(line).write.text(path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])
    source = tables.read_csv(spark, path, header=False, schema=schema, malformed="malformed_line")
    return plan_gate(source, orders_config(), malformed="malformed_line").rejects()


def _latest_orders(spark: SparkSession, sf_dir: str, **options) -> Gate:
    """One accepted order per customer: the last one, by date and amount."""
    config = replace(orders_config(), duplicate_check=["customer_id"])
    source = dirty_orders(spark, sf_dir)
    return plan_gate(source, config, latest_by=["order_date", "amount"], **options)


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest_orders(spark, sf_dir).accepted()


def key_duplicate_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest_orders(spark, sf_dir).rejects()


def latest_line_per_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key with few values and many rows each: the last line per status."""
    config = replace(_LINEITEM, duplicate_check=["l_returnflag", "l_linestatus"])
    source = table(spark, sf_dir, "lineitem")
    gate = plan_gate(source, config, latest_by=["l_shipdate", "l_orderkey", "l_linenumber"])
    return gate.accepted()


def explained_reject_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger with the check and the column behind every failure."""
    return _latest_orders(spark, sf_dir, explain=True).rejects()


def cast_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted values that the declared types cannot hold."""
    source = table(spark, sf_dir, "customer").select(
        *(F.col(c).cast("string") for c in ("c_custkey", "c_name")),
        F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("c_acctbal"),
    )
    return plan_gate(source, _LOSSY).cast_losses()


# --- typed tables --------------------------------------------------------


def _typed_config(**rules_and_columns) -> GateConfig:
    return GateConfig("", "", "", "", **rules_and_columns)


def typed_negative_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "customer")
    rule = rules.negative_rule("c_acctbal", source.schema["c_acctbal"].dataType)
    return split.rule_rejects(tally(source, [rule]), rules.NEGATIVE)


_LINEITEM = _typed_config(
    required_cols=("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"),
    null_check=("l_returnflag", "l_linestatus"),
    no_negative_value=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    dateformatchecks=("l_shipdate",),
    cols_datatype={"l_extendedprice": "decimal(12,2)", "l_shipdate": "date"},
)


def typed_gate_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_gate(table(spark, sf_dir, "lineitem"), _LINEITEM).accepted()


_CUSTOMER = _typed_config(
    required_cols=("*",), null_check=("c_mktsegment",), no_negative_value=("c_acctbal",)
)

_LOSSY = _typed_config(
    required_cols=("*",),
    no_negative_value=("c_acctbal",),
    cols_datatype={"c_custkey": "tinyint", "c_name": "int", "c_acctbal": "decimal(5,2)"},
)


_SUPPLIER = _typed_config(
    required_cols=("s_suppkey", "s_name", "s_acctbal"),
    null_check=("s_name",),
    no_negative_value=("s_acctbal", "s_nationkey"),
    cols_datatype={"s_acctbal": "decimal(12,2)"},
)


def typed_gate_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_gate(table(spark, sf_dir, "supplier"), _SUPPLIER).accepted()


# Few distinct rows with very many copies: the hot-row case.
_EVENTS = _typed_config(
    required_cols=("event_type",), null_check=("event_type",), dateformatchecks=("day",)
)


_STATUSES = _typed_config(required_cols=("l_linestatus",))


def hot_row_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.when(F.col("event_type") != "error", F.date_trunc("MONTH", "ts").cast("date"))
    source = table(spark, sf_dir, "events").select("event_type", day.alias("day"))
    return plan_gate(source, _EVENTS).rejects()


def hot_line_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line once per unit of its quantity, by its status alone: rows with
    far more copies than one chunk holds, counted after they are dealt out."""
    units = F.sequence(F.lit(1), F.col("l_quantity").cast("int"))
    source = table(spark, sf_dir, "lineitem").select(F.explode(units), "l_linestatus")
    ledger = plan_gate(source.select("l_linestatus"), _STATUSES).rejects()
    return ledger.groupBy("l_linestatus", "reject_reason").agg(F.count("*").alias("rows"))


def document_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surplus copies among the documents, whole texts compared."""
    source = table(spark, sf_dir, "documents").drop("doc_id")
    return split.duplicate_rows(tally(source, []))


# --- SQL -----------------------------------------------------------------

_ALL = ", ".join(COLUMNS)
_RANKED = f"r AS (SELECT *, row_number() OVER (PARTITION BY {_ALL} ORDER BY order_id) AS rn FROM d)"
_UNIQUE = "u AS (SELECT DISTINCT * FROM d)"
_DUPLICATES = f"SELECT {_ALL}, 'Duplicate record' AS reject_reason FROM r WHERE rn > 1"
_NULLS = " UNION ALL ".join(
    f"SELECT {_ALL}, 'Null Record' AS reject_reason FROM u WHERE {c} IS NULL"
    for c in ("customer_id", "status")
)
# The fixture's amounts have no exponent and fit an int, so "integer part
# below zero" is "at most -1".
_NEGATIVE = (
    f"SELECT {_ALL}, 'Negative Value' AS reject_reason FROM u WHERE TRY_CAST(amount AS double) "
)
_DATES = (
    f"SELECT {_ALL}, 'Incorrect Dateformat' AS reject_reason FROM u "
    "WHERE TRY_CAST(order_date AS timestamp) IS NULL"
)


def _ledger(negative: str) -> str:
    branches = f"{_DUPLICATES} UNION ALL {_NULLS} UNION ALL {negative} UNION ALL {_DATES}"
    return f"WITH {DIRTY_SQL}, {_RANKED}, {_UNIQUE}, ledger AS ({branches})"


_LEDGER = _ledger(_NEGATIVE + "<= -1")
_ACCEPTED = f"{_LEDGER}, a AS (SELECT * FROM d EXCEPT ALL SELECT {_ALL} FROM ledger)"
_CASTS = (
    "TRY_CAST(order_id AS bigint) AS order_id, TRY_CAST(customer_id AS bigint) AS customer_id"
)
_AMOUNT_AND_DATE = (
    "TRY_CAST(amount AS decimal(12,2)) AS amount, TRY_CAST(order_date AS date) AS order_date"
)
_PROJECTED = f"{_ACCEPTED} SELECT {_CASTS}, {_AMOUNT_AND_DATE} FROM a"
_COUNTS = (
    "(SELECT count(*) FROM d) AS sourcecount, "
    "(SELECT count(*) FROM ledger) AS rejectcount, "
    "(SELECT count(*) FROM a) AS writtencount"
)
_LINEITEM_OK = (
    "l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL AND l_shipdate IS NOT NULL "
    "AND NOT coalesce(l_quantity < 0 OR l_extendedprice < 0 OR l_discount < 0 OR l_tax < 0, false)"
)
_CENTS = "CAST(l_extendedprice AS decimal(12,2))"
_WHOLE = f"CAST(trunc({_CENTS}) AS bigint)"

_KEYED = f"""{_LEDGER}, keyed AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id
    ORDER BY TRY_CAST(order_date AS date) DESC NULLS LAST,
      TRY_CAST(amount AS decimal(12,2)) DESC NULLS LAST,
      {", ".join(f"{c} DESC NULLS LAST" for c in COLUMNS)}) AS place
  FROM (SELECT * FROM d EXCEPT ALL SELECT {_ALL} FROM ledger))"""
_EXPLAINED = "SELECT {columns}, '{reason}' AS reject_reason, {check} AS reject_check, {column} AS reject_column FROM {rows}"


def _explained(reason: str, check: str, column: str, rows: str) -> str:
    return _EXPLAINED.format(columns=_ALL, reason=reason, check=check, column=column, rows=rows)


_LINES = ", ".join(f"coalesce({c}, '')" for c in COLUMNS)
_MALFORMED = f"""m AS (
  SELECT order_id, customer_id, status, amount, order_date,
    CASE WHEN CAST(order_id AS bigint) % 37 <> 0 THEN priority END AS priority,
    CASE WHEN CAST(order_id AS bigint) % 37 = 0
         THEN concat_ws(',', {", ".join(f"coalesce({c}, '')" for c in COLUMNS[:-1])})
         WHEN CAST(order_id AS bigint) % 43 = 0 THEN concat_ws(',', {_LINES}, 'surplus')
    END AS malformed_line
  FROM d), u AS (SELECT DISTINCT * FROM m)"""

ORACLES: dict[str, str] = {
    "csv_scan_header": f"WITH {DIRTY_SQL} SELECT * FROM d",
    "csv_scan_headerless": f"WITH {DIRTY_SQL}, x AS (SELECT * FROM d UNION ALL SELECT "
    + ", ".join(f"'{c}'" for c in COLUMNS)
    + ") SELECT "
    + ", ".join(f"{c} AS _c{at}" for at, c in enumerate(COLUMNS))
    + " FROM x",
    "config_rule_branches": f"""WITH {DIRTY_SQL}, {_UNIQUE}
        SELECT 'null_check' AS param, 'customer_id' AS column_name,
          (SELECT count(*) FROM u WHERE customer_id IS NULL) AS failures
        UNION ALL SELECT 'null_check', 'status', (SELECT count(*) FROM u WHERE status IS NULL)
        UNION ALL SELECT 'no_negative_value', 'amount',
          (SELECT count(*) FROM u WHERE TRY_CAST(amount AS double) <= -1)
        UNION ALL SELECT 'dateformatchecks', 'order_date',
          (SELECT count(*) FROM u WHERE TRY_CAST(order_date AS timestamp) IS NULL)""",
    "dated_paths": """SELECT processed_date, count(*) AS orders,
          '/lake/landing/orders/' || processed_date AS source_path,
          '/lake/target/orders/' || processed_date AS target_path,
          '/lake/pending/orders/' || processed_date AS pending_path,
          '/lake/audit/orders/' || processed_date AS audit_path
        FROM (SELECT strftime(o_orderdate, '%Y/%m/%d') AS processed_date FROM orders)
        GROUP BY processed_date""",
    "table_names": "SELECT page_id, split_part(split_part(url, '/', -1), '.', 1) AS tablename "
    "FROM pages",
    "duplicate_rank": f"WITH {DIRTY_SQL}, {_RANKED} SELECT * FROM r",
    "duplicate_rows": f"WITH {DIRTY_SQL}, {_RANKED} {_DUPLICATES}",
    "unique_rows": f"WITH {DIRTY_SQL} SELECT DISTINCT * FROM d",
    "null_rejects": f"WITH {DIRTY_SQL}, {_UNIQUE} {_NULLS}",
    "negative_rejects": f"WITH {DIRTY_SQL}, {_UNIQUE} {_NEGATIVE} <= -1",
    "negative_rejects_exact": f"WITH {DIRTY_SQL}, {_UNIQUE} {_NEGATIVE} < 0",
    "date_rejects": f"WITH {DIRTY_SQL}, {_UNIQUE} {_DATES}",
    "reject_ledger": f"{_LEDGER} SELECT * FROM ledger",
    "reject_ledger_exact": f"{_ledger(_NEGATIVE + '< 0')} SELECT * FROM ledger",
    "reject_reason_counts": f'{_LEDGER} SELECT reject_reason, count(*) AS "rows" FROM ledger '
    "GROUP BY reject_reason",
    "accepted_rows": f"{_ACCEPTED} SELECT * FROM a",
    "accepted_cast": f"{_ACCEPTED} SELECT {_CASTS}, status, {_AMOUNT_AND_DATE}, priority FROM a",
    "accepted_projected": _PROJECTED,
    "accepted_all_columns": f"{_ACCEPTED} SELECT {_CASTS}, status, {_AMOUNT_AND_DATE}, priority "
    "FROM a",
    "gate_counts": f"{_ACCEPTED} SELECT 'orders' AS tablename, {_COUNTS}",
    "gate_reconcile": f"""{_ACCEPTED},
        f AS (SELECT greatest(count(*) - 1, 0) AS extra FROM ledger
          WHERE reject_reason <> 'Duplicate record' GROUP BY {_ALL})
        SELECT {_COUNTS}, (SELECT count(*) FROM u) AS uniquecount,
          (SELECT CAST(sum(extra) AS bigint) FROM f) AS overlap, true AS reconciles""",
    "text_to_integer": f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
          CAST(-{_WHOLE} AS integer) AS cut, CAST({_WHOLE} AS integer) AS plain,
          CAST(NULL AS integer) AS exponent, CAST(NULL AS integer) AS words,
          CASE WHEN {_WHOLE} <= 32768 THEN CAST(-{_WHOLE} AS smallint) END AS cut_smallint
        FROM lineitem""",
    "sink_parquet_roundtrip": _PROJECTED,
    "sink_reject_csv_roundtrip": f"{_LEDGER} SELECT * FROM ledger",
    "sink_audit_csv_roundtrip": f"""{_ACCEPTED} SELECT tablename,
          CAST(sourcecount AS varchar) AS sourcecount,
          CAST(rejectcount AS varchar) AS rejectcount,
          CAST(writtencount AS varchar) AS writtencount
        FROM (SELECT 'orders' AS tablename, {_COUNTS})""",
    "gate_end_to_end": _PROJECTED,
    "gate_end_to_end_rejects": f"{_LEDGER} SELECT * FROM ledger",
    "gate_end_to_end_audit": f"{_ACCEPTED} SELECT 'orders' AS tablename, {_COUNTS}",
    "rule_folder_tables": f"""{_ACCEPTED}, c AS (SELECT *,
            c_mktsegment IS NULL AS a, coalesce(c_acctbal < 0, false) AS b FROM customer),
          s AS (SELECT *, s_name IS NULL AS a, coalesce(s_acctbal < 0, false) AS b,
            coalesce(s_nationkey < 0, false) AS e FROM supplier)
        SELECT 'orders' AS tablename, {_COUNTS}
        UNION ALL SELECT 'customer', count(*), CAST(sum(a::int + b::int) AS bigint),
          count(*) FILTER (NOT a AND NOT b) FROM c
        UNION ALL SELECT 'supplier', count(*), CAST(sum(a::int + b::int + e::int) AS bigint),
          count(*) FILTER (NOT a AND NOT b AND NOT e) FROM s""",
    "malformed_line_ledger": f"""WITH {DIRTY_SQL}, {_MALFORMED}
        SELECT {_ALL}, malformed_line, 'Duplicate record' AS reject_reason
        FROM (SELECT *, row_number() OVER (PARTITION BY {_ALL}, malformed_line) AS rn FROM m)
        WHERE rn > 1
        UNION ALL SELECT *, 'Malformed record' FROM u WHERE malformed_line IS NOT NULL
        UNION ALL SELECT *, 'Null Record' FROM u WHERE customer_id IS NULL
        UNION ALL SELECT *, 'Null Record' FROM u WHERE status IS NULL
        UNION ALL SELECT *, 'Negative Value' FROM u WHERE TRY_CAST(amount AS double) <= -1
        UNION ALL SELECT *, 'Incorrect Dateformat' FROM u
          WHERE TRY_CAST(order_date AS timestamp) IS NULL""",
    "latest_per_key": f"{_KEYED} SELECT {_CASTS}, {_AMOUNT_AND_DATE} FROM keyed WHERE place = 1",
    "key_duplicate_ledger": f"{_KEYED} SELECT * FROM ledger UNION ALL "
    f"SELECT {_ALL}, 'Duplicate key' FROM keyed WHERE place > 1",
    "latest_line_per_status": f"""SELECT l_orderkey, l_linenumber, l_quantity,
          {_CENTS} AS l_extendedprice, CAST(l_shipdate AS date) AS l_shipdate
        FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus
            ORDER BY CAST(l_shipdate AS date) DESC, l_orderkey DESC, l_linenumber DESC) AS place
          FROM (SELECT DISTINCT * FROM lineitem WHERE {_LINEITEM_OK})) WHERE place = 1""",
    "explained_reject_ledger": _KEYED
    + " "
    + " UNION ALL ".join(
        _explained(*branch)
        for branch in (
            ("Duplicate record", "NULL", "NULL", "r WHERE rn > 1"),
            ("Null Record", "'null_check'", "'customer_id'", "u WHERE customer_id IS NULL"),
            ("Null Record", "'null_check'", "'status'", "u WHERE status IS NULL"),
            ("Negative Value", "'no_negative_value'", "'amount'",
             "u WHERE TRY_CAST(amount AS double) <= -1"),
            ("Incorrect Dateformat", "'dateformatchecks'", "'order_date'",
             "u WHERE TRY_CAST(order_date AS timestamp) IS NULL"),
            ("Duplicate key", "'duplicate_check'", "'customer_id'", "keyed WHERE place > 1"),
        )
    ),
    "cast_losses": """WITH c AS (SELECT DISTINCT c_custkey, c_name,
            CAST(c_acctbal AS decimal(12,2)) AS balance FROM customer),
          a AS (SELECT * FROM c WHERE balance > -1 OR balance IS NULL)
        SELECT 'c_custkey' AS column_name, 'tinyint' AS "type",
          count(*) FILTER (c_custkey > 127) AS losses FROM a
        UNION ALL SELECT 'c_name', 'int', count(c_name) FROM a
        UNION ALL SELECT 'c_acctbal', 'decimal(5,2)', count(*) FILTER (balance >= 1000) FROM a""",
    "faithful_reject_roundtrip": "SELECT *, 'Incorrect Dateformat' AS reject_reason "
    "FROM documents",
    "typed_negative_customers": "SELECT DISTINCT *, 'Negative Value' AS reject_reason "
    "FROM customer WHERE c_acctbal < 0",
    "typed_gate_lineitem": f"""SELECT l_orderkey, l_linenumber, l_quantity,
          {_CENTS} AS l_extendedprice, CAST(l_shipdate AS date) AS l_shipdate
        FROM (SELECT DISTINCT * FROM lineitem WHERE {_LINEITEM_OK})""",
    "typed_gate_supplier": """SELECT s_suppkey, s_name,
          CAST(s_acctbal AS decimal(12,2)) AS s_acctbal
        FROM (SELECT DISTINCT * FROM supplier
          WHERE s_name IS NOT NULL AND s_acctbal >= 0 AND s_nationkey >= 0)""",
    "hot_row_ledger": """WITH e AS (SELECT event_type,
            CASE WHEN event_type <> 'error' THEN CAST(date_trunc('month', ts) AS date) END AS day
          FROM events),
        r AS (SELECT *, row_number() OVER (PARTITION BY event_type, day) AS rn FROM e)
        SELECT event_type, day, 'Duplicate record' AS reject_reason FROM r WHERE rn > 1
        UNION ALL
        SELECT event_type, day, 'Incorrect Dateformat' FROM r WHERE rn = 1 AND day IS NULL""",
    "hot_line_ledger": """SELECT l_linestatus, 'Duplicate record' AS reject_reason,
          CAST(sum(CAST(l_quantity AS integer)) AS bigint) - 1 AS "rows"
        FROM lineitem GROUP BY l_linestatus""",
    "document_copies": """SELECT "text", lang, source, n_chars, 'Duplicate record' AS reject_reason
        FROM (SELECT *, row_number() OVER (PARTITION BY "text", lang, source, n_chars) AS rn
          FROM documents) WHERE rn > 1""",
}

QUERIES = {
    query.__name__: query
    for query in (
        csv_scan_header,
        csv_scan_headerless,
        config_rule_branches,
        dated_paths,
        table_names,
        duplicate_rank,
        duplicate_rows,
        unique_rows,
        null_rejects,
        negative_rejects,
        negative_rejects_exact,
        date_rejects,
        reject_ledger,
        reject_ledger_exact,
        reject_reason_counts,
        accepted_rows,
        accepted_cast,
        accepted_projected,
        accepted_all_columns,
        gate_counts,
        gate_reconcile,
        text_to_integer,
        sink_parquet_roundtrip,
        sink_reject_csv_roundtrip,
        sink_audit_csv_roundtrip,
        gate_end_to_end,
        gate_end_to_end_rejects,
        gate_end_to_end_audit,
        faithful_reject_roundtrip,
        rule_folder_tables,
        malformed_line_ledger,
        latest_per_key,
        key_duplicate_ledger,
        latest_line_per_status,
        explained_reject_ledger,
        cast_losses,
        typed_negative_customers,
        typed_gate_lineitem,
        typed_gate_supplier,
        hot_row_ledger,
        hot_line_ledger,
        document_copies,
    )
}
