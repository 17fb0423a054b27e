"""tidemark: campaign audience, blast assembly and KPI attribution on Spark.

Every operator is a function ``DataFrame(s) -> DataFrame``; dates and
campaign constants are arguments, never ``current_date()``.  Sources live in
``tidemark.sources``, sinks in ``tidemark.sinks``, column helpers in
``tidemark.functions`` and the registered query plans in ``tidemark.plans``.
"""

__all__ = ["session", "operators", "sources", "sinks", "functions", "plans"]
