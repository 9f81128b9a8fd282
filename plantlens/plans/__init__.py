"""Plans: multi-step jobs over the operators (curated layer, refresh, checks)."""
