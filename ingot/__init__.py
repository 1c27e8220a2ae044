"""ingot: turn large snapshots of nested gzip NDJSON into clean, versioned tables on Spark.

Layout
------
functions/  Column builders (nested repair, JSON predicates, text index).
sources/    Scans: tolerant/strict NDJSON, manifests, file listings, ledgers, schema files.
operators/  DataFrame -> DataFrame operators: repair rules, selection, validation,
            schema profiling, load strictness, contract check.
sinks/      NDJSON and table writers, ledger appends, schema files.
plans/      End-to-end plans (convert, validate, load, publish) and the driver stand-ins.
streaming/  Ledger-driven incremental intake with Structured Streaming.
"""

__all__ = ["session"]
