"""threadloom: conversation-log analytics on Spark DataFrames."""
