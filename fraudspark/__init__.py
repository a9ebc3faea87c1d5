"""fraudspark: card-fraud analytics as Spark DataFrame operators.

Layout:
  schema        declared StructTypes and fixed constants
  functions/    column-expression helpers (JVM-side, codegen friendly)
  sources/      readers, the driver-data adapter, tables and sinks
  operators/    DataFrame -> DataFrame operators (features, split, metrics, drift, ...)
  streaming/    Structured Streaming stateful scoring
  plans/        batch jobs and the query catalog used by the entry module
"""

__all__ = ["schema"]
