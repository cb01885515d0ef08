"""Row shapes and step names."""

from __future__ import annotations

from pyspark.sql import types as T

# Step names as they are stored in ``execution_name``.
HARVEST = "OAI_HARVEST"
VALIDATION_EXTERNAL = "VALIDATION_EXTERNAL"
TRANSFORMATION = "TRANSFORMATION"
VALIDATION_INTERNAL = "VALIDATION_INTERNAL"
NORMALIZATION = "NORMALIZATION"
ENRICHMENT = "ENRICHMENT"
MEDIA = "MEDIA"
INDEXING = "INDEXING"

STEP_NAMES = (
    HARVEST,
    VALIDATION_EXTERNAL,
    TRANSFORMATION,
    VALIDATION_INTERNAL,
    NORMALIZATION,
    ENRICHMENT,
    MEDIA,
    INDEXING,
)

RECORD_KEY = ["dataset_id", "execution_id", "record_id"]
RECORD_COLUMNS = ["dataset_id", "execution_id", "execution_name", "record_id", "record_data"]
ERROR_COLUMNS = ["dataset_id", "execution_id", "execution_name", "record_id", "exception"]
RESULT_COLUMNS = [*RECORD_COLUMNS, "exception"]


def _row(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _L, _I, _B, _TS = (
    T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampType(),
)

EXECUTION_RECORD = _row(*((name, _S) for name in RECORD_COLUMNS))
EXCEPTION_LOG = _row(*((name, _S) for name in ERROR_COLUMNS))
STEP_RESULT = _row(*((name, _S) for name in RESULT_COLUMNS))
TASK_INFO = _row(("task_id", _L), ("commit_count", _L), ("write_count", _L))
ITERATION_STATE = _row(
    ("dataset_id", _S), ("execution_id", _S), ("emitted_count", _I), ("last_identifier", _S),
)
HEADER = _row(("identifier", _S), ("deleted", _B), ("datestamp", _TS), ("sets", T.ArrayType(_S)))
HARVESTED = _row(("external_id", _S), ("timestamp", _TS), ("content", T.BinaryType()))
NOTIFICATION = _row(
    ("task_id", _L), ("resource", _S), ("result_resource", _S), ("info_text", _S),
    ("job_name", _S), ("marked_as_deleted", _B),
)
TASK_PARAMS = _row(
    ("task_id", _L), ("sent_date", _TS), ("output_mime_type", _S), ("provider_id", _S),
    ("dataset_id", _S), ("new_representation_name", _S), ("revision_provider_id", _S),
    ("revision_name", _S), ("revision_timestamp", _TS),
)
TASK_MESSAGE = _row(("task_id", _S), ("task_name", _S), ("file_url", _S))
