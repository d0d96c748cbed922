"""Relational operators over registry tables, and the parsers that turn documents into rows."""
