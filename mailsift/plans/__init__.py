"""Plans: the digest composition, stand-in derivations, query catalog and SQL oracles."""
