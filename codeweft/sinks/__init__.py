"""Event log and versioned tables."""
