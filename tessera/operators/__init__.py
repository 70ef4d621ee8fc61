"""DataFrame operators: profiles, cleaning, encoders, splits, models,
evaluation, tuning and experiments."""
