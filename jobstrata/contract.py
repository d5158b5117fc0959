"""Table contracts: column order, types, and the Avro form of the raw contract."""

from __future__ import annotations

import json
import warnings

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Column names and their order. Inserts are positional, so the order is
# part of the contract.
RAW_COLUMNS = (
    "job_id",
    "posting_year",
    "country",
    "region",
    "city",
    "company_name",
    "company_size",
    "industry",
    "job_title",
    "seniority_level",
    "ai_mentioned",
    "ai_keywords",
    "ai_intensity_score",
    "core_skills",
    "ai_skills",
    "salary_usd",
    "salary_change_vs_prev_year_percent",
    "automation_risk_score",
    "reskilling_required",
    "ai_job_displacement_risk",
    "job_description_embedding_cluster",
    "industry_ai_adoption_stage",
)
YEAR_COLUMN = "posting_year"
MEASURE_COLUMNS = (
    "salary_usd",
    "ai_intensity_score",
    "automation_risk_score",
    "ai_job_displacement_risk",
)
TEXT_COLUMNS = ("country", "region", "industry", "seniority_level")
FLAG_COLUMNS = ("ai_mentioned", "reskilling_required")
GROUP_COLUMNS = (
    "posting_year",
    "country",
    "region",
    "industry",
    "seniority_level",
    "risk_category",
)


def string_schema(names) -> T.StructType:
    """All-nullable-string schema over ``names``."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _curated_type(name: str) -> T.DataType:
    if name == YEAR_COLUMN:
        return T.IntegerType()
    return T.DoubleType() if name in MEASURE_COLUMNS else T.StringType()


RAW = string_schema(RAW_COLUMNS)
CURATED = T.StructType(
    [T.StructField(name, _curated_type(name)) for name in RAW_COLUMNS]
    + [T.StructField("risk_category", T.StringType())]
)
FUNCTIONAL = T.StructType(
    string_schema(GROUP_COLUMNS).fields
    + [
        T.StructField("avg_salary_usd", T.DoubleType()),
        T.StructField("median_salary_usd", T.DoubleType()),
        T.StructField("avg_ai_intensity", T.DoubleType()),
        T.StructField("avg_automation_risk", T.DoubleType()),
        T.StructField("avg_displacement_risk", T.DoubleType()),
        T.StructField("job_count", T.LongType()),
        T.StructField("pct_ai_mentioned", T.DoubleType()),
        T.StructField("unique_job_titles", T.LongType()),
    ]
)

_AVRO_TO_SPARK = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bytes": T.BinaryType(),
}


def avro_contract(schema: T.StructType, record: str) -> str:
    """The Avro record schema (JSON) of a flat all-string table."""
    for field in schema.fields:
        if not isinstance(field.dataType, T.StringType):
            raise ValueError(f"{field.name}: only string columns are part of the Avro contract")
    fields = [{"name": field.name, "type": ["string", "null"]} for field in schema.fields]
    return json.dumps({"type": "record", "name": record, "fields": fields})


def parse_avro_contract(text: str) -> T.StructType:
    """Flat Avro record schema -> ``StructType``; a union with null makes a nullable column."""
    record = json.loads(text)
    if not isinstance(record, dict) or record.get("type") != "record":
        raise ValueError("not an Avro record schema")
    fields = []
    for field in record["fields"]:
        union = field["type"] if isinstance(field["type"], list) else [field["type"]]
        branches = [branch for branch in union if branch != "null"]
        if len(branches) != 1 or branches[0] not in _AVRO_TO_SPARK:
            raise ValueError(f"{field['name']}: unsupported Avro type {field['type']!r}")
        fields.append(
            T.StructField(field["name"], _AVRO_TO_SPARK[branches[0]], nullable="null" in union)
        )
    return T.StructType(fields)


def load_avro_contract(
    spark: SparkSession, path: str, fallback: T.StructType = RAW
) -> T.StructType:
    """Read an ``.avsc`` file from any file system Spark reaches.

    An unreadable or malformed file is reported as a warning and ``fallback`` is returned.
    """
    try:
        row = spark.read.text(path, wholetext=True).first()
        return parse_avro_contract(row[0] if row else "")
    except (PySparkException, Py4JJavaError, ValueError, KeyError) as error:
        warnings.warn(f"contract {path} not usable, falling back to all strings: {error}")
        return fallback
