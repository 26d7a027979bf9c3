"""Input tables, snapshot storage and their schemas."""
