"""Vector expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

DIMS = 256


def squared_l2(a: Column, b: Column) -> Column:
    """Sum of squared differences, in double; null where the lengths differ."""
    squares = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.when(F.size(a) == F.size(b), F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where either vector is all zeros."""
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(0.0))


def embed(df: DataFrame, text: str, out: str = "vec", dims: int = DIMS) -> DataFrame:
    """Adds a vector per text: hashed word counts, unit length. Queries and documents alike.

    The stand-in for an embedding model; ``embed_with`` in ``operators.batch`` takes a real one.
    """
    words = RegexTokenizer(inputCol=text, outputCol="_words", pattern="(?U)\\W+", toLowercase=True)
    counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dims)
    unit = Normalizer(inputCol="_counts", outputCol="_unit", p=2.0)
    whole = df.withColumn(text, F.coalesce(F.col(text), F.lit("")))
    done = unit.transform(counts.transform(words.transform(whole)))
    return done.withColumn(out, vector_to_array("_unit", "float32")).drop("_words", "_counts", "_unit")
