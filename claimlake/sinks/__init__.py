"""Table writers and keyed upserts."""
