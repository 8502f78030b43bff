"""Compositions: the gold layer and the end-to-end chains."""
