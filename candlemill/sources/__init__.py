"""Landing of raw responses and files, and the tables facts are kept in."""
