"""tracelake: trajectory analytics and curation on Spark DataFrames."""
