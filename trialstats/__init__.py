"""Statistics of repeated performance trials as lazy Spark DataFrame plans."""
