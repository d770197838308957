"""Silver transforms, the gold table, jobs by name and the bronze-to-gold run."""
