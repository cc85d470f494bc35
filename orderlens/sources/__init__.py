"""Where order data comes from and where results go."""
