"""Plan-level pieces: layer orchestration, distributed numbering, query catalog, oracles."""
