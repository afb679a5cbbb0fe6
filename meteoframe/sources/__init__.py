"""Feed readers (text, fixed width, XML, JSON, CSV, tables) and test-table stand-ins."""
