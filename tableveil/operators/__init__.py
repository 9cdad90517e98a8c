"""Jobs over tables, schemas and catalogs."""
