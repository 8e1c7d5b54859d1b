"""Column functions: ids, text, time and JSON, event contracts."""
