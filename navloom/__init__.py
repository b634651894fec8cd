"""Fund analytics as Spark DataFrame transformations over long tables."""
