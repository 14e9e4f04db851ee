"""loanmart: loan-servicing and payroll data-mart operators on Spark.

Every operator takes and returns DataFrames and stays lazy; only sinks and
explicit checks run actions.
"""

__version__ = "0.1.0"
