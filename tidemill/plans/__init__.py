"""Ready-made reports, documents and loads."""
