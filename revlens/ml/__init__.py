"""Feature stages, classifiers, stacking and search."""
