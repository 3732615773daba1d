"""Facts, marts, live views and the daily run."""
