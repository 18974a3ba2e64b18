"""Readers of the files the engine takes."""
