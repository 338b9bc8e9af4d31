"""Daily video-engagement analytics on Spark: bronze JSON to silver and gold Parquet, and reports."""
