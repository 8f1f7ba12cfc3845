"""Analytics of plate-based imaging screens as Spark DataFrame functions."""
