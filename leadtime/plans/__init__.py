"""Composite plans: fixture views, feature flows, seasonality, models,
and the registry that binds operators to the test tables."""
