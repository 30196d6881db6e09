"""hearth — Spark-native building-stock analytics.

Ingests drifting raw sources into typed silver tables, keeps the latest
record per property, parses banded/range text into numbers, builds area
rankings, retrofit cost scenarios and breakdowns, a greedy cheapest-cover
selection per property, clustering / principal components / forest
attribution, and profiling and data-quality checks — all as DataFrame and
MLlib jobs.
"""

__all__ = ["session"]
