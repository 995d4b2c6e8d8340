"""Control: manifests, steps that run once, configuration, the active-learning loop."""
