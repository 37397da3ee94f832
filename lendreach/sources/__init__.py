"""Reading, schemas and writing."""
