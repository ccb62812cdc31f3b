"""Training-data operators over documents and embeddings, each a Spark job."""
