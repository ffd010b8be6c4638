"""Reading raw files, writing and re-reading tables, reading and writing build logs."""
