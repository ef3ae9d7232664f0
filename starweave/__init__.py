"""starweave: a Spark-native toolkit for remodelling delimited records into a
star schema (typed loads, projections, unpivots, name parsing, lookups,
distributed surrogate keys, table loads and a bounded message drain)."""

__version__ = "0.1.0"
