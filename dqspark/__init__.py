"""dqspark: data-quality checks for healthcare operations tables on Spark.

Checks are functions from DataFrames to DataFrames of findings; findings are
gathered into an append-only audit log and summarised into pass/fail status
and quality metrics.
"""

__version__ = "0.1.0"
