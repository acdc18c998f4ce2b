"""Part of sluice."""
