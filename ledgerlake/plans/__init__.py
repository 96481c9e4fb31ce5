"""Plans: the registered query catalog and multi-stage jobs."""
