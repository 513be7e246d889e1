"""Driver-side planning: rules, their validation and compilation to Catalyst expressions."""
