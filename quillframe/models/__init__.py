"""Feature preparation, model fitting and evaluation."""
