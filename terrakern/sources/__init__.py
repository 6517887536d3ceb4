"""Tables, catalogues and the versioned pixel store."""
