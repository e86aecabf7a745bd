"""Lots scored as their files arrive."""
