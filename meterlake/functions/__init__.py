"""Column functions shared by sources and plans."""
