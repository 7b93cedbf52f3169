"""rollbook — student-records extracts as Spark DataFrame plans.

Layout
------
sources/    driver-table loading, SIS-shaped views, CSV sinks
functions/  column-level helpers (text, codes, dates) — pure Column -> Column
operators/  DataFrame -> DataFrame building blocks (filters, joins, dedup,
            validation, fallback rows, rendering)
plans/      one function per extract, the registry and the batch runner
streaming/  intentionally empty: the extracts are nightly batch jobs
"""

from rollbook.params import ExtractParams

__all__ = ["ExtractParams"]
