"""Reading landed vendor pages and stored tables, and writing them."""
