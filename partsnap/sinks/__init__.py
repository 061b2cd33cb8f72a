"""Table writes: create the backup, overwrite partitions or the whole table, drop partitions."""
