"""Network-flow analytics and intrusion classification on Spark DataFrames."""
