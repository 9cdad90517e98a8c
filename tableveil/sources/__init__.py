"""Reading tables and catalogs."""
