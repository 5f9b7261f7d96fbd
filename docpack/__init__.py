"""docpack: moving document collections in and out of archives and between stores, on Spark."""
