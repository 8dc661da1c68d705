"""signalloom: evidence-stream analytics written as Spark DataFrame jobs."""
