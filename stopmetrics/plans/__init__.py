"""Multi-step plans: the warehouse models, the insights on top of them, and the raw lake."""
