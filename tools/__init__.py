"""Developer tools: oracle check and plan summary."""
