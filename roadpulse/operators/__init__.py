"""Table operators: roads, history, patterns, scoring, dashboards, features, models."""
