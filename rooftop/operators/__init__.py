"""DataFrame operators of the building-height pipeline."""
