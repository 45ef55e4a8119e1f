"""docpipe: documentation corpora and exact vector retrieval as Spark DataFrame jobs."""
