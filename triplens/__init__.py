"""Travel-content analytics on PySpark: trends, hot spots, text search, page rank."""
