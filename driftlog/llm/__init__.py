"""Training-data operators over text tables: scoring, filtering, sharding,
joining, packaging and tokenising at corpus scale.

Nothing else in the library imports this package.
"""
