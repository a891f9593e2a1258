from tallywright.sources import files, tables

__all__ = ["files", "tables"]
