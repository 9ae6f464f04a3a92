"""Training-data operators on whole corpora; nothing else in the library imports this subpackage."""
