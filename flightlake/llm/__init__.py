"""Training-data operators: filtering, deduplication, tokenizing, packing and
search over ``documents``, ``pages`` and ``embeddings``. Nothing else in the
library imports this package; :mod:`flightlake.llm.queries` registers it."""
