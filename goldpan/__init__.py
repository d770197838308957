"""Batch and arrival-driven jobs that turn raw purchase and review CSVs into analytics tables."""
