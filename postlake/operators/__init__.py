"""DataFrame operators: frequencies/top-k, profiles, dedup, lookups, extraction."""
