"""tailframe: shipping database server logs with Spark, and proving that they arrived."""
