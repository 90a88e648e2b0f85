"""kerbflow: Spark-native trip and mobility analytics.

Every public operator takes DataFrames (plus plain parameters) and returns a
DataFrame; nothing trip-sized ever reaches the driver.
"""

__version__ = "0.1.0"
