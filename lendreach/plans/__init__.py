"""List builders, fact tables and measurement, composed from the operators."""
