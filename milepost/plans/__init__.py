"""Business plans: history, training, forecast, review rules and checks."""
