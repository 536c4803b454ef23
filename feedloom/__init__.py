"""feedloom: supplier-feed normalisation on Spark.

Feeds from many suppliers, each with its own layout, become one canonical,
typed, deduplicated product model under declarative mapping files.
"""

__version__ = "0.1.0"
