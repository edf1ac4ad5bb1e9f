"""Sources (S1-S11): JSON trees, JSON arrays, customer items, quarantine."""
