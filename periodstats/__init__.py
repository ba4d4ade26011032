"""periodstats: entity-period statistics on Spark (landing, cleaning, star schema,
history features, position-relative scoring, clustering, BI measures)."""

__version__ = "0.1.0"
