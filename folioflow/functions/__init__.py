"""Part of folioflow."""
