"""The consumer-credit dataset: its column spec, its layers, and the whole run."""
