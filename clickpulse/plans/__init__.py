"""Jobs assembled from operators: speed layer, batch layer, read-back views."""
