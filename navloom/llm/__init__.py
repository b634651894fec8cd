"""Operators for training-data pipelines: sharding, joins, classifiers, archives, mixing, packing."""
