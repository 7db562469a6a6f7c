"""streaming of pulselake."""
