"""Operators over text corpora; nothing outside this subpackage imports them."""
