"""Order-fulfilment report operators for Spark DataFrames."""
