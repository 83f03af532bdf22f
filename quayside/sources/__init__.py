"""Sources: catalog documents, JSON/CSV readers, zip archives and the landing tree."""
