"""The registered queries: inputs derived from the supplied tables, queries, and oracle SQL."""
