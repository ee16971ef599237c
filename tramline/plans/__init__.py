"""User-level analyses (``transit``, ``bikes``) and the query registry."""
