"""Transit feed analytics as plain DataFrame functions, batch and streaming."""
