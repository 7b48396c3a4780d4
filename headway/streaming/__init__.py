"""Streaming drivers around the same operators that batch uses."""
