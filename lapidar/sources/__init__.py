"""Table schemas, CSV landing files, JDBC extraction and the layered lake."""
