"""Row-wise features on unbounded input."""
