"""The mart itself: relations, models, assertions and the build order."""
