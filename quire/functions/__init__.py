"""Part of quire."""
