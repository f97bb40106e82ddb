"""recordmill: landed web payloads to clean, canonical record tables, as Spark jobs."""
