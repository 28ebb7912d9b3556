"""Analytics operators for activity and transaction data, written for Spark.

Every operator is a function from DataFrames to a DataFrame whose column names
are parameters. Nothing runs until an action, apart from the few operators that
say so (they measure a size, write a table, or fit a model).
"""
