"""DataFrame operators: frames, components, metrics, cohorts, volumes, splits, weights."""
