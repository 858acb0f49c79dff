"""Feed-recommendation analytics on Spark DataFrames.

``functions``  column expressions: property bags, guards, scores, list text.
``sources``    readers and writers for the logs, dictionaries, lists and state.
``operators``  DataFrame -> DataFrame steps, from popularity to key-value export.
``plans``      the daily chain, and the queries bound to the sample tables.
"""
