"""caseloom."""
