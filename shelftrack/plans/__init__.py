"""Models, analyses and checks."""
