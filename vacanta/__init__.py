"""Job-postings analytics built from Spark DataFrame, SQL and streaming operators."""
