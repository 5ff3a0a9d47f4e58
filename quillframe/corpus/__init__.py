"""Text-corpus preparation."""
