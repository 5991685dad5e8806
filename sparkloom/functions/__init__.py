"""Column functions: text, URLs, HTML and wikitext."""
