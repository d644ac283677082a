"""Declared bronze, silver and metadata schemas, and schema identity."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.types import StructField, StructType

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


def _struct(columns: str) -> StructType:
    """``"name type, name type!"``; an exclamation mark means NOT NULL. Needs no session."""
    fields = []
    for column in columns.split(","):
        name, kind = column.split()
        fields.append(StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")))
    return StructType(fields)


_STAMP = "fetched_at timestamp!, batch_id string!"

# Column names, types, order and nullability of every stored layer.
_LAYERS = {
    "psa_bronze": "series_code string!, period string!, value double, unit string, "
    f"source string!, {_STAMP}",
    "psa_silver": "period_date date!, period_year int!, period_month int!, series_code string!, "
    "value double, unit string, source string!",
    "bsp_fx_bronze": "rate_date string!, currency_pair string!, rate double, "
    f"source string!, {_STAMP}",
    "bsp_fx_silver": "period_date date!, currency_pair string!, rate double!, source string!",
    "bsp_policy_silver": "decision_date date!, overnight_rp double!, overnight_srp double, "
    "direction string!, source string!",
}

#: What the landing step accepts per source: the bronze columns before stamping.
_RECORDS = {
    "psa": "series_code string, period string, value double, unit string, source string",
    "bsp_fx": "rate_date string, currency_pair string, rate double, source string",
    "bsp_policy": "decision_date string, overnight_rp double, overnight_srp double, "
    "direction string, source string",
}

_METADATA = {
    "pipeline_runs": "run_id string, pipeline_name string, source string, run_date date, "
    "started_at timestamp, ended_at timestamp, status string, records_ingested bigint, "
    "records_rejected bigint, error_message string",
    "stage_metrics": "id bigint, run_id string, stage_name string, started_at timestamp, "
    "duration_seconds double, input_rows bigint, output_rows bigint",
    "dataset_versions": "id bigint, run_id string, dataset_name string, partition_key string, "
    "row_count bigint, schema_hash string, s3_path string, created_at timestamp",
    "processed_batches": "source string, batch_date date, run_id string, processed_at timestamp",
    "quality_results": "id bigint, run_id string, check_name string, passed boolean, "
    "failed_count bigint, threshold double",
    "file_manifest": "id bigint, source string, fetch_date date, file_path string, "
    "sha256_hash string, byte_size bigint, batch_id string, status string, fetched_at timestamp",
}


def _layer(source: str, layer: str) -> StructType:
    name = f"{source}_{layer}"
    if name not in _LAYERS:
        raise KeyError(f"no {layer} schema is registered for source {source!r}")
    return _struct(_LAYERS[name])


def get_bronze_schema(source: str) -> StructType:
    return _layer(source, "bronze")


def get_silver_schema(source: str) -> StructType:
    return _layer(source, "silver")


def record_schema(source: str) -> StructType:
    if source not in _RECORDS:
        raise KeyError(f"unknown source {source!r}")
    return _struct(_RECORDS[source])


def metadata_schema(table: str) -> StructType:
    return _struct(_METADATA[table])


METADATA_TABLES = tuple(_METADATA)


def schema_hash(df: DataFrame) -> str:
    """Identity of names and types; column order and nullability do not matter."""
    types = {field.name: str(field.dataType) for field in df.schema.fields}
    return hashlib.sha256(json.dumps(types, sort_keys=True).encode()).hexdigest()
