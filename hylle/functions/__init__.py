"""Column functions: text, dictionary, URL and id rules."""
