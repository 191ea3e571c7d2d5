"""pushlake: push-message and user-profile analytics on Spark DataFrames.

Subpackages:

* ``functions``: Column expressions (Java string semantics, time keys, coordinates).
* ``operators``: DataFrame -> DataFrame operators (parsers, cell lookups, ordered
  runs, merges, roll-ups, cubes, alerts).
* ``sources``: readers and writers.
* ``streaming``: Structured Streaming consumers.
* ``plans``: checked queries over inputs derived from the driver tables.
* ``jobs``: the end-to-end programs.
"""
