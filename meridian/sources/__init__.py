"""Readers, generators and table storage."""
