"""Column functions: normalisation, geometry encodings, viewer styling."""
