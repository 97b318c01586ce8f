"""DataFrame operators: silver parsing, latest-per-key, gold mapping and roll-up, quality rules."""
