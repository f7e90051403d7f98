"""The layer-to-layer plans: silver, gold, staging, marts, refreshes and reports."""
