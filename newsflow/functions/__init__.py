"""Column expressions (pure ``pyspark.sql.functions`` compositions, no UDFs)."""

from newsflow.functions import dates, deals, text  # noqa: F401
