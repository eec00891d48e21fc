"""Set-wise analytics over corpora of shredded scientific documents, on Spark DataFrames."""
