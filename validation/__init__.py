"""Runs the engine on the driver's tables and checks it against plain SQL."""
