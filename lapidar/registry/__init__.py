"""Named queries over the driver's tables and the SQL they are compared with."""
