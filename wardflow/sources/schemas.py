"""Declared schemas of the base tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _B, _TS = T.StringType(), T.DateType(), T.BooleanType(), T.TimestampNTZType()


def _struct(required: str, optional: dict[str, T.DataType], **defaults: str) -> T.StructType:
    fields = [T.StructField(n, _S, False) for n in required.split()]
    for name, type_ in optional.items():
        meta = {"default": defaults[name]} if name in defaults else {}
        fields.append(T.StructField(name, type_, True, meta))
    return T.StructType(fields)


NOW = "current_timestamp()"

PATIENT = _struct(
    "pat_id pat_mrn",
    {
        "pat_first_name": _S,
        "pat_last_name": _S,
        "birth_date": _D,
        "ssn": _S,
        "address_line_1": _S,
        "city": _S,
        "state": _S,
        "zip_code": _S,
        "phone": _S,
        "email": _S,
        "prim_language": _S,
        "gender": _S,
        "load_ts": _TS,
    },
    load_ts=NOW,
)

ENCOUNTER = _struct(
    "encounter_id pat_id",
    {
        "encounter_type": _S,
        "admit_date": _D,
        "discharge_date": _D,
        "department": _S,
        "attending_prov_id": _S,
        "primary_dx_code": _S,
        "primary_dx_name": _S,
        "encounter_status": _S,
        "total_charges": T.DecimalType(12, 2),
        "load_ts": _TS,
    },
    load_ts=NOW,
)

LAB_RESULT = _struct(
    "result_id encounter_id pat_id",
    {
        "test_code": _S,
        "test_name": _S,
        "result_value": T.DecimalType(10, 2),
        "result_unit": _S,
        "reference_low": T.DecimalType(10, 2),
        "reference_high": T.DecimalType(10, 2),
        "result_date": _TS,
        "load_ts": _TS,
    },
    load_ts=NOW,
)

PROVIDER = _struct(
    "prov_id",
    {"prov_name": _S, "specialty": _S, "department": _S, "npi": _S, "active": _B},
    active="true",
)

RUN_LOG = _struct(
    "",
    {
        "run_id": _S,
        "step_name": _S,
        "log_level": _S,
        "message": _S,
        "detail": T.VariantType(),
        "logged_at": _TS,
    },
    logged_at=NOW,
)

IMPORT_CONFIG = _struct(
    "",
    {
        "config_id": T.LongType(),
        "source_schema": _S,
        "source_table": _S,
        "target_schema": _S,
        "target_table": _S,
        "key_columns": _S,
        "enabled": _B,
    },
)

IMPORT_STATUS = _struct("source_table", {"last_run_ts": _TS, "last_run_status": _S})

VENDOR_LAB = _struct(
    "",
    {
        "vendor_id": _S,
        "pat_mrn": _S,
        "test_code": _S,
        "test_name": _S,
        "result_value": _S,
        "result_unit": _S,
        "result_date": _D,
        "abnormal_yn": _S,
    },
)

BATCH_RUN = _struct("batch_id state", {"at": _TS})

ROLE_ACCESS = _struct("role_name", {"department": _S})

TAG_REFERENCE = _struct(
    "tag_name tag_value domain",
    {"object_database": _S, "object_schema": _S, "object_name": _S, "column_name": _S},
)

REFRESH_HISTORY = T.StructType(
    [
        T.StructField("name", _S, False),
        T.StructField("state", _S, False),
        T.StructField("state_message", _S),
        T.StructField("batch_id", T.LongType()),
        T.StructField("touched_cells", T.LongType()),
        T.StructField("refresh_start_time", _TS),
        T.StructField("refresh_end_time", _TS),
    ]
)
