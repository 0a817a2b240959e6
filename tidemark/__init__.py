"""Change-event analytics as DataFrame jobs, in batch and in streams."""
