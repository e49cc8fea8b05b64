"""DataFrame operators: document structure, fragments, discovery, status, metrics, packing, embedding, indexes."""
