"""The analyses: pure functions from DataFrame to lazy DataFrame."""
