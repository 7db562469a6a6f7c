"""sources of pulselake."""
