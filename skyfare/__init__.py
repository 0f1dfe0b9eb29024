"""skyfare: a Spark-native flight-fare warehouse.

Layers: landing JSON -> ODS append log -> star schema (calendar, airports,
routes, flight types, Type-2 airline dimension) -> fact table with named
rejects -> quality reports -> five aggregate marts and report/dashboard
queries.  Everything is DataFrame / Spark SQL with built-in functions.
"""

__version__ = "0.1.0"
