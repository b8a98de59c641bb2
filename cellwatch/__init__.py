"""cellwatch: hourly network-activity analytics expressed as Spark DataFrame plans.

Every operator is a function from DataFrames to a DataFrame built from Spark's own
expressions, joins, aggregates and windows; nothing is collected to the driver.
"""

__version__ = "0.1.0"
