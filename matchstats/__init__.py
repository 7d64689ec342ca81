"""matchstats: Spark-native analytics over two-sided contest logs.

Every operator is a function from DataFrames (plus column-name parameters)
to a DataFrame.  Nothing is collected to the driver except bounded,
size-checked dimension tables and model metrics.
"""

__version__ = "0.1.0"
