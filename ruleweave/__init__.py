"""Detection analytics on Spark: declarative rules compiled to Catalyst expressions."""

from ruleweave.errors import RuleError

__all__ = ["RuleError"]
