"""Rule-based extraction of shipping records from documents, on Spark."""

from .plans.rules import CLOUD, LOCAL, RuleSet  # noqa: F401
