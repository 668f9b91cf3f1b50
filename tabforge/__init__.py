"""tabforge: Spark-native tabular preparation, feature synthesis and model comparison.

Every operator is a DataFrame -> DataFrame function (fit functions return
small state).  See README.md for the operator map.
"""

__version__ = "0.1.0"
