"""Registered queries by subject."""

from millrace.plans import answers, catalog, chat, churn, ranking, star, text, tools, vectors  # noqa: F401
from millrace.plans.registry import CHECKS, QUERIES  # noqa: F401
