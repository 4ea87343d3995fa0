"""Typed CSV load of the raw tables into Parquet, with an audit row per table.

Text follows the usual database convention: an unquoted empty field is NULL, a quoted one is an
empty string, and a quote inside a quoted field is doubled.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shopscope.sources.schemas import AUDIT_SCHEMA, RAW_SCHEMAS, unpadded
from shopscope.sources.split_records import multi_line_records
from shopscope.sources.workspace import Workspace

# Spark takes an unquoted empty field for NULL as soon as the NULL marker is anything but empty;
# this marker cannot occur in the text of a database export.
_NULL_MARKER = "\0"

# Tables whose text may hold line breaks.
MULTI_LINE_TABLES = frozenset({"reviews"})

_FORMAT = {"mode": "FAILFAST", "quote": '"', "escape": '"', "nullValue": _NULL_MARKER}


def read_csv(spark: SparkSession, table: str, path: str, multi_line: bool | None = None, workspace: Workspace | None = None) -> DataFrame:
    """The file or folder at ``path`` as ``table``. Columns go by position; a bad row fails the job.

    Text with line breaks is read once when this is called, to find where records start; what that pass notes of each
    split is kept in ``workspace``, or in one of its own that lasts as long as the application.
    """
    schema = RAW_SCHEMAS[table]
    if table in MULTI_LINE_TABLES if multi_line is None else multi_line:
        kinds = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema)
        parsed = F.from_csv("record", kinds, {**_FORMAT, "lineSep": "\n"})
        records = multi_line_records(spark, path, Workspace(spark, workspace and workspace.location(table)))
        rows = records.select(parsed.alias("row")).select("row.*")
    else:
        rows = spark.read.schema(schema).csv(path, header=True, enforceSchema=True, **_FORMAT)
    return unpadded(rows, table)


def write_csv(df: DataFrame, path: str) -> None:
    """The counterpart of ``read_csv``."""
    df.write.mode("overwrite").csv(
        path,
        header=True,
        quote='"',
        escape='"',
        nullValue="",
        emptyValue='""',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def load(spark: SparkSession, files: dict[str, str], target: str) -> dict[str, DataFrame]:
    """Replace ``target/<table>`` by the content of each CSV and log it in ``target/load_audit``.

    Independent loads are submitted together and rows are counted while they are written. The log
    has a row for each load that ended well; the first failure is raised after the others are done.
    """

    def one(table: str) -> tuple:
        seen = Observation(f"load_{table}")
        counted = read_csv(spark, table, files[table], workspace=workspace).observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").parquet(f"{target}/{table}")
        return table, datetime.now(UTC).replace(tzinfo=None), seen.get["rows"], "SUCCESS"

    workspace = Workspace(spark)
    with ThreadPoolExecutor(max(1, len(files))) as pool:
        loads = [pool.submit(one, table) for table in files]
    workspace.discard()
    done = [load.result() for load in loads if load.exception() is None]
    spark.createDataFrame(done, AUDIT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{target}/load_audit")
    for load in loads:
        load.result()
    return {table: spark.read.schema(RAW_SCHEMAS[table]).parquet(f"{target}/{table}") for table in files}


def load_audit(spark: SparkSession, target: str) -> DataFrame:
    """The audit log, newest entry first."""
    log = spark.read.schema(AUDIT_SCHEMA).parquet(f"{target}/load_audit")
    return log.orderBy(F.desc("load_timestamp"), "table_name")
