"""Registers, payload readers and the projections from payloads to observations."""
