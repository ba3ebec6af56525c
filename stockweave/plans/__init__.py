"""Models: staging, intermediate, dimensions, facts, reports, features and planning."""
