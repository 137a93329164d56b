"""Training, evaluation and scoring of MLlib regressors on feature tables."""
