"""Writers: table partitions, whole-table replacement and text backups."""
