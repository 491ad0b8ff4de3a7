"""Readers: hourly counter files, auxiliary feeds, seeds, and listings."""
