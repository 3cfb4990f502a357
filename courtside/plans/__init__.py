"""The three entry points: refresh, training and prediction."""
