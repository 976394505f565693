"""lexmill: bilingual text-unit quality analytics on Spark DataFrames."""
