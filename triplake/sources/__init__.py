"""Readers: the lake's own layers, seed files and the event bus."""
