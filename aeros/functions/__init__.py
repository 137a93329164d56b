"""Part of aeros; see README.md."""
