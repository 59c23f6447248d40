"""Relational operators on one frame or on a pair of frames."""
