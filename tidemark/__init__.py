"""tidemark: campaign-metrics ingest and attribution on Spark DataFrames."""
