"""functions of pulselake."""
