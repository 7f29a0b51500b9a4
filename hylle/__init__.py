"""Product-catalogue analytics on PySpark: parse, enrich, merge and track."""
