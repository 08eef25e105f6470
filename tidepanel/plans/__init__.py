"""The four stages: clean, explore, test, forecast."""
