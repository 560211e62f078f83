"""Column-level building blocks: rules, addresses, domain features, similarity."""
