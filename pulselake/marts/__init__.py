"""marts of pulselake."""
