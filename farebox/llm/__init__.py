"""Operators of a training-data pipeline over document tables.

Nothing else in the library imports this subpackage.  Python code of these operators runs
inside Spark tasks; the package is sent to the executors when an operator is first used.
"""
