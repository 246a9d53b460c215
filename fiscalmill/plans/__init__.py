"""The fiscal-risk models, reports, cards and insights."""
