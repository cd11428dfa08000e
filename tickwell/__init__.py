"""tickwell: market-tick ingestion and analysis as Spark DataFrame jobs."""
