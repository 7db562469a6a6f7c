"""tables of pulselake."""
