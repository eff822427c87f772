"""Daily trade, price and portfolio analytics as Spark DataFrame jobs."""
