"""Training-data operators (numbered queries ``opN_*`` and the pipeline)."""
