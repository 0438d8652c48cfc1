"""The queries of this subpackage and their SQL, where SQL can express them."""

from lexloom.llm import alignment, embeddings, imatch, jaccard, langid, lines, mixing, negatives, packing, pii, secrets, tokens, warc

_MODULES = (lines, pii, tokens, jaccard, imatch, warc, secrets, langid, packing, embeddings, negatives, alignment, mixing)
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in _MODULES for k, v in getattr(m, "SQL", {}).items()}
