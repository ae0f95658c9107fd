"""sievework: a Spark-first engine for curating nested records and text corpora."""
