"""Click-event lakehouse on Spark: Bronze copies, Silver cleaning, Gold star schema, reports."""
