"""Which fields, of which types, messages really carry.

Each message is parsed once, into a VARIANT, so fields that no schema names
are seen, too; a report per field and type shows drift from the expected one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KINDS = {"OBJECT": "object", "ARRAY": "array", "STRING": "string", "BOOLEAN": "boolean", "VOID": "null"}


def _kind(schema: Column) -> Column:
    """JSON type of a value from its variant schema; all that is left is a number."""
    out = None
    for prefix, kind in _KINDS.items():
        out = (F.when if out is None else out.when)(schema.startswith(prefix), kind)
    return out.otherwise("number")


_MISSING = "missing"


def payload_fields(messages: DataFrame, col: str = "value", expected: Sequence[str] = ()) -> DataFrame:
    """One row per message and top-level field: ``field, kind``, and one of
    kind ``missing`` for each of the ``expected`` fields that a message lacks.
    Messages that are no JSON object have a row with the field null, of kind
    ``malformed`` or, for other JSON, of the value's kind."""
    d = messages.select(F.try_parse_json(F.col(col)).alias("v"))
    kind = F.when(F.col("v").isNull(), F.lit("malformed")).otherwise(_kind(F.schema_of_variant("v")))
    d = d.withColumn("whole", kind).withColumn("m", F.expr("CASE WHEN whole = 'object' THEN try_cast(v AS map<string, variant>) END"))
    own = F.transform(F.map_entries("m"), lambda e: F.struct(e["key"].alias("field"), _kind(F.schema_of_variant(e["value"])).alias("kind")))
    whole = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.col("whole").alias("kind")))
    rows = F.coalesce(own, whole)
    if expected:
        names = F.array(*[F.lit(x) for x in sorted(expected)])
        lacking = F.array_except(names, F.coalesce(F.map_keys("m"), F.array().cast("array<string>")))
        rows = F.concat(rows, F.transform(lacking, lambda x: F.struct(x.alias("field"), F.lit(_MISSING).alias("kind"))))
    return d.select(F.explode(rows).alias("f")).select("f.field", "f.kind")


def payload_drift(messages: DataFrame, expected: dict[str, str], col: str = "value") -> DataFrame:
    """Messages per field and kind with a verdict: ``ok``, ``type`` (another
    kind than expected), ``unknown`` (a field that is not expected),
    ``malformed``; and ``missing``, of no kind, for the messages without an
    expected field. One pass, counted map-side: a row per field and kind is
    shuffled by each task."""
    counts = payload_fields(messages, col, list(expected)).groupBy("field", "kind").agg(F.count(F.lit(1)).alias("messages"))
    want = F.lit(None).cast("string")
    if expected:
        want = F.element_at(F.create_map(*[F.lit(x) for kv in sorted(expected.items()) for x in kv]), F.col("field"))
    kind = F.col("kind")
    verdict = F.when(F.col("field").isNull(), "malformed").when(want.isNull(), "unknown").when(kind == _MISSING, _MISSING).when(want == kind, "ok").otherwise("type")
    return counts.select("field", F.when(kind != _MISSING, kind).alias("kind"), "messages", verdict.alias("verdict"))
