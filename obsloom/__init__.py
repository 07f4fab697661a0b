"""Analytics on time-stamped observations, written as Spark DataFrame operators."""
