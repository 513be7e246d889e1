"""Log, rule, changelog and alert sources."""
