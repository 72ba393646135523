"""quarry: composable PySpark analytics over DataFrames and streams.

Every public function takes DataFrames (or a SparkSession) and returns a
DataFrame, a streaming query or a fitted Spark ML model. Nothing collects
result rows to the driver; all work is expressed with built-in column
expressions so Catalyst sees (and optimises) the whole plan.
"""

__version__ = "0.1.0"
