"""Table definition, whole-table changes and counts."""
