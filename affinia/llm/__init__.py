"""Operators that clean a training corpus; each module holds one, by its own method."""
