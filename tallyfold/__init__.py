"""Evidence analytics over articles, registries and event logs, as DataFrame functions."""
