"""Writers: document tables, JSON Lines, CSV."""
