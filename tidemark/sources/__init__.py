"""Inputs, schemas and table storage."""
