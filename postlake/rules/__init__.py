"""Fixed rule tables. Every value here must equal the source behaviour, so the
tables are kept as plain data in their natural order."""
