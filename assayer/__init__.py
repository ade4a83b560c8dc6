"""Evaluation and audit analytics as Spark DataFrame transformations.

``functions``  column expressions, no shuffle
``operators``  DataFrame -> DataFrame building blocks
``sources``    readers and sinks
``plans``      end-to-end questions composed from operators
``streaming``  the ledger semantics as Structured Streaming jobs
``catalog``    each operator bound to tables, with the SQL it must agree with
"""
