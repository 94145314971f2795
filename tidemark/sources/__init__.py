"""Raw feeds, stored tables and the star-schema adapters."""
