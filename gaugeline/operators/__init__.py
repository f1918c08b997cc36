"""DataFrame to DataFrame transforms; row-level ones work on batches and streams alike."""
