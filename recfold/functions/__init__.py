"""Column expressions: no data is read and no job is run here."""
