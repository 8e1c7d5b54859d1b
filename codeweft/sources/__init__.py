"""Source trees, the event log, progress rows and snapshots."""
