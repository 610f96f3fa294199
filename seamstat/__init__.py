"""seamstat: player-season analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` whose entity, team,
season and event columns are parameters, so one code path serves pitch-level
sports events and any other event table with the same shape.
"""

__version__ = "0.1.0"
