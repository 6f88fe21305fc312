"""JSON documents and logs: run summaries, audit events, saved results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = (
    "timestamp string, status string, question string, has_sql_override boolean, requested_max_rows int, sql string, "
    "execution_ms long, warnings array<string>, confidence string, requires_clarification boolean, "
    "clarification_question string, agent_step_statuses array<struct<name:string,status:string>>, "
    "error_type string, error_detail string"
)

RUN_RESULTS_SCHEMA = "metadata struct<invocation_id:string,generated_at:string>, results array<struct<status:string>>"


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON files with one document or one array of documents each."""
    return spark.read.schema(schema).json(path, multiLine=True)


def read_run_results(spark: SparkSession, path: str) -> DataFrame:
    """One row per result of each run-result document."""
    docs = read_documents(spark, path, RUN_RESULTS_SCHEMA)
    return docs.select(F.col("metadata.invocation_id"), F.explode_outer("results").alias("r")).select("invocation_id", "r.status")


def read_audit_log(spark: SparkSession, path: str) -> DataFrame:
    """Audit events, one JSON line each."""
    return spark.read.schema(AUDIT_SCHEMA).json(path)


def read_run_documents(spark: SparkSession, root: str, job: str) -> DataFrame:
    """The raw text of all run documents of a job, with file name and age."""
    folder = f"{root.rstrip('/')}/metadata/pipeline_runs/{job}"
    docs = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(folder, wholetext=True)
    return docs.select(
        F.col("value").alias("doc"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    )


def latest_documents(docs: DataFrame, key: Column) -> DataFrame:
    """The newest document per key; equally old ones are told apart by path."""
    newest = F.max_by(F.struct("doc", "file_name", "file_path", "modified_at"), F.struct("modified_at", "file_path"))
    return docs.groupBy(key.alias("key")).agg(newest.alias("d")).select("key", "d.*")


def find_run(docs: DataFrame, run_id: str) -> DataFrame:
    """The newest document that carries the run id in its path or its content."""
    named = F.col("file_path").contains(run_id) | (F.get_json_object("doc", "$.run_id") == run_id)
    return docs.where(named).orderBy(F.desc("modified_at"), F.desc("file_path")).limit(1)


def audit_events(requests: DataFrame) -> DataFrame:
    """Shape requests and their responses as audit events. Result rows are never part of one."""
    have = set(requests.columns)

    def col(name: str, kind: str) -> Column:
        return (F.col(name) if name in have else F.lit(None)).cast(kind).alias(name)

    empty = F.array().cast("array<string>")
    warnings = F.coalesce(F.col("warnings"), empty) if "warnings" in have else empty
    steps_type = "array<struct<name:string,status:string>>"
    steps = F.col("agent_step_statuses") if "agent_step_statuses" in have else F.array()
    return requests.select(
        col("timestamp", "string"),
        col("status", "string"),
        col("question", "string"),
        col("has_sql_override", "boolean"),
        col("requested_max_rows", "int"),
        col("sql", "string"),
        col("execution_ms", "long"),
        warnings.alias("warnings"),
        col("confidence", "string"),
        F.coalesce(col("requires_clarification", "boolean"), F.lit(False)).alias("requires_clarification"),
        col("clarification_question", "string"),
        steps.cast(steps_type).alias("agent_step_statuses"),
        col("error_type", "string"),
        col("error_detail", "string"),
    )
