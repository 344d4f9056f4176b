"""tabsift: profiling, cleaning, encoding, feature selection and forest comparison on Spark DataFrames.

Every operator is a plain function over DataFrames (usable with ``df.transform``) or returns a fitted
``pyspark.ml`` model.  Results that the reference only logged (counts, scores, importances) are
returned as DataFrames.
"""

from tabsift.spec import ForestConfig, TableSpec

__all__ = ["ForestConfig", "TableSpec"]
