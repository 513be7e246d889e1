"""Domain errors."""


class RuleError(ValueError):
    """A rule, a rule envelope or a condition cannot be used.

    Raised on the driver while a rule set is compiled, before any job runs.
    """
