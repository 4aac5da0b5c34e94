"""MLlib featurisation, models and the retraining lifecycle."""
