"""shoal: integration of long-running fish monitoring surveys on Spark.

Packages: ``functions`` (Column expressions and null rules), ``operators``
(DataFrame operators), ``sources`` (scans and sinks), ``plans`` (jobs and the
registered queries), ``streaming`` (intentionally empty, see its docstring).
"""

__version__ = "0.1.0"
