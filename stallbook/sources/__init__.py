"""Files in, tables out, and the row counts in between."""
