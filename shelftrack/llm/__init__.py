"""Operators for preparing training texts and searching vectors."""
