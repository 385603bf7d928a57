"""Column-level semantics: NA-aware aggregates, safe arithmetic, string rules, labels."""
