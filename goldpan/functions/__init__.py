"""Column functions used by the silver transforms."""
