"""Composed jobs: the batch folder job, the capture job, session history and
the contract queries run against the driver's tables."""
