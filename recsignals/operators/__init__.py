"""DataFrame -> DataFrame feature operators."""
