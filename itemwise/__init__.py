"""itemwise: a Spark-native item labelling, encoding, training and scoring library.

Every operator is a function from DataFrame(s) to DataFrame, built from
Spark SQL expressions so Catalyst can prune, push down and code-generate.
"""

__version__ = "0.1.0"
