"""quality of pulselake."""
