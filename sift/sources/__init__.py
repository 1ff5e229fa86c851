"""What the job reads and writes: rule files, dated paths, tables, staging."""
