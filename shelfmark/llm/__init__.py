"""Operators of a training-data pipeline: packing, counting, cleaning, mixing and
formatting of whole text corpora. Nothing else in the library imports this package."""
