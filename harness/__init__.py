"""Test inputs, registered queries and their SQL counterparts (not part of the library)."""
