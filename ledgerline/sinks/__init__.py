"""Writers (K1-K8): every target is a URI parameter (local path, HDFS, object store)."""
