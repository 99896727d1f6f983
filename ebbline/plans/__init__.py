"""Multi-operator jobs: the wide feature matrix and model training."""
