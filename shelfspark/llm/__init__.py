"""Training-data operators over document, conversation and embedding tables."""
