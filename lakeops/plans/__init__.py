"""Composed jobs: operators, sources and sinks in order, with a status per step."""
