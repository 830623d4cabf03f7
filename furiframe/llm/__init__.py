"""Operators for large-scale training-data pipelines (sharding, de-duplication,
classifiers, tokenisation, packing). Nothing else in the library imports this
subpackage; ``queries`` holds the registered queries and their SQL."""
