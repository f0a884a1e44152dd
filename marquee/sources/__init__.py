"""Landing folders, stored tables, fixtures and lookups."""
