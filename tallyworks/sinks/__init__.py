"""Writers for tables, CSV exports, views and JDBC targets."""
