"""Fixed vocabularies and schemas of the evidence model."""

from __future__ import annotations

from pyspark.sql import types as T

SCHEMA_VERSION = "trace-event/v1"

#: Fixed values of the event contract.
EVENT_TYPES = (
    "MODEL_REQUEST", "MODEL_RESPONSE", "TOOL_CALL", "TOOL_RESULT", "SANDBOX_STARTED", "SANDBOX_COMMAND", "SANDBOX_FINISHED", "VERIFICATION_STARTED",
    "VERIFICATION_FINISHED", "EPISODE_FINISHED", "HARNESS_DECISION", "CONTEXT_SELECTED", "CONTEXT_COMPACTED", "RETRY_SCHEDULED", "TERMINATION_DECIDED",
)
COMPONENTS = ("MODEL", "HARNESS", "TOOL", "SANDBOX", "MODEL_BACKEND", "EVALUATOR", "EXTERNAL_SERVICE")
STATUSES = ("STARTED", "SUCCEEDED", "FAILED", "ERROR", "TIMEOUT", "CANCELLED", "UNKNOWN")
#: What an opened span is closed by.
SPAN_PAIRS = (
    ("MODEL_REQUEST", "MODEL_RESPONSE"), ("TOOL_CALL", "TOOL_RESULT"), ("SANDBOX_STARTED", "SANDBOX_FINISHED"), ("VERIFICATION_STARTED", "VERIFICATION_FINISHED"),
)
INTEGRITY = ("COMPLETE", "PARTIAL", "CORRUPT")
ATTESTED = ("PASSED", "FAILED", "ERROR", "TIMEOUT")
TASK_STATUS = ("SUCCESS", "FAILURE", "UNKNOWN")
VALIDITY = ("VALID", "INFRA_INVALID", "UNKNOWN")

EVENT = T.StructType(
    [
        T.StructField("schema_version", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("episode_id", T.StringType()),
        T.StructField("trace_id", T.StringType()),
        T.StructField("span_id", T.StringType()),
        T.StructField("parent_span_id", T.StringType()),
        T.StructField("sequence", T.LongType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("component", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("attempt", T.LongType()),
        T.StructField("attributes", T.StringType()),
        T.StructField("artifact_refs", T.ArrayType(T.StringType())),
    ]
)
