"""textloom: text-corpus preparation expressed as Spark DataFrame jobs."""
