"""sheafline: document analytics on Spark DataFrames."""
