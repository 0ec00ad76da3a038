"""Member analytics for a subscription business, as PySpark DataFrame operators."""
