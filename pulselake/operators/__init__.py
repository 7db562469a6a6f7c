"""operators of pulselake."""
