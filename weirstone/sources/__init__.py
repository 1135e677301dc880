"""Reading source files and documents, writing tables."""
