"""Pure Column functions: text in, text out, no Python in the hot path."""
