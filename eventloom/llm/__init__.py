"""Training-data operators: dedup, language ID, sharding, packing, token files, LM scores, mixing.

Every operator takes and returns DataFrames; intermediate tables go to the folder named by
``spark.checkpoint.dir``.  Nothing else in the library imports this subpackage.
"""
