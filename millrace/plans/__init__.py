"""Multi-step plans: blocking, TF-IDF, pair features, entity resolution."""
