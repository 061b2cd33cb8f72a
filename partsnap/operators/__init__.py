"""Row diffs, profiles, volumes, gates, schema comparison and load/retention slices."""
