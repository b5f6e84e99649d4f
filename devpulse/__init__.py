"""devpulse: device-telemetry analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function made of Spark's
built-in expressions, so Catalyst can push filters, prune columns and keep
the work inside whole-stage codegen.
"""

__version__ = "0.1.0"
