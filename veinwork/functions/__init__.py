"""Column expressions: parsing, calendar features, bins and hash order."""
