"""Jobs: the transforms wired to tables."""
