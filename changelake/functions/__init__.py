"""Column functions: JSON columns, enumerations, references, name patterns."""
