"""Composite plans: silver build, gold build, the end-to-end layer run, and the
registered query catalog."""
