"""Flight on-time analytics on Spark DataFrames.

Layers: ``sources`` (raw CSV / registry text / lake / fixtures) ->
``functions`` (Column expressions) -> ``operators`` (the analyses) ->
``plans`` (named queries) -> ``sinks``; ``streaming`` for incremental ingest.
"""

__version__ = "0.1.0"
