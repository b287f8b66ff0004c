"""Multi-step plans: load, marts, views, publication."""
